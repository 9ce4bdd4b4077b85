"""Pages labelled by hand, none of which weights are fitted on: what stands between ⟦ and ⟧ is the article."""

PAGES = [
    # class names around the whole article that sound like boilerplate
    '<html><body class="has-banner menu-open"><div class="topnav"><a href=/>Home</a> <a href=/b>Blog</a></div><article><h1>⟦Fishing in winter⟧</h1><p>⟦The lake freezes in January, and the fishermen cut round holes into the ice.⟧</p><p>⟦They sit there for hours with a flask of tea.⟧</p></article><div class="bottom"><a href=/i>Imprint</a></div></body></html>',
    '<body><ul class="nav"><li><a href=/>Start</a><li><a href=/x>Boats</a></ul><article class="notice"><h1>⟦Roof work begins⟧</h1><p>⟦From Monday the roof of the town hall will be covered with new slates.⟧</p><p>⟦The office stays open, but the door on the square is closed.⟧</p></article><footer>Town hall, all rights reserved</footer></body>',
    '<body><header><a href=/>Pharmacy letter</a></header><div id="side-effects"><h2>⟦Side effects of the new drops⟧</h2><p>⟦Most people feel a slight burning in the eye that goes away after a minute or two.⟧</p><p>⟦Whoever sees worse the next morning should stop and ask a doctor.⟧</p></div><aside><h4>Topics</h4><a href=/1>Eyes</a> <a href=/2>Ears</a></aside></body>',
    '<body><div class="menu"><a href=/a>Courts</a><a href=/b>Laws</a></div><div class="legal"><h1>⟦When a promise binds⟧</h1><p>⟦A promise made before witnesses binds the one who gave it, even if nothing was written down.⟧</p><p>⟦The court asks what a sensible person would have understood.⟧</p><p>⟦Silence is no promise.⟧</p></div><div class="footer"><a href=/p>Privacy</a></div></body>',
    # anchors
    '<body><a id=top><nav><a href=/>Home</a><a href=/m>Music</a></nav><article><h1>⟦The organ returns⟧</h1><p>⟦After four years in the workshop the old organ stands in its place again.⟧</p><p>⟦Each of the two thousand pipes was cleaned by hand.⟧</p></article></body>',
    '<body><div><a href=/>Paper</a></div><div class="story"><h1>⟦A bridge of rope⟧</h1><p>⟦See the <a href=/map>map of the valley before you set out, since the path is not marked.⟧</p><p>⟦The bridge holds six people at a time, and it sways a little in the wind.⟧</p><p>⟦On the far side a hut offers soup and bread to all who come.⟧</p></div></body>',
    '<body><div class="links"><a href=/1>One<a href=/2>Two<a href=/3>Three</a></div><main><h1>⟦Bees on the roof⟧</h1><p>⟦Three hives stand on the roof of the school, and the pupils look after them.⟧</p><p>⟦The honey is sold at the summer fair.⟧</p></main></body>',
    # linked paragraphs, lists and formulas inside the article
    '<body><nav><a href=/>Home</a> <a href=/t>Tours</a></nav><article><h1>⟦Three walks⟧</h1><p>⟦All three walks begin at the station and take less than four hours.⟧</p><ul><li>⟦<a href=/w1>Along the stream⟧</a></li><li>⟦<a href=/w2>Over the hill⟧</a></li><li>⟦<a href=/w3>Around the lake⟧</a></li></ul><p>⟦Good shoes are enough for all of them, and there is water on the way.⟧</p></article><footer><a href=/c>Contact</a></footer></body>',
    '<body><div id="nav"><a href=/>Maths</a> <a href=/q>Quiz</a></div><div class="lesson"><h1>⟦The square of a sum⟧</h1><p>⟦Whoever multiplies a sum by itself gets three terms, as a drawing shows at once.⟧</p><p>⟦It holds that <math><mi>a</mi><mo>=</mo><mi>b</mi></math> whenever both sides are cut alike.⟧</p><p>⟦The middle term counts twice, which is often forgotten.⟧</p></div></body>',
    '<body><div class="head"><a href=/>Herald</a></div><div class="article-text"><h1>⟦Ants share the work⟧</h1><p>⟦In a colony of ants nobody gives orders, and yet every task is done in time.⟧</p><p class="social">⟦Social insects divide the work by age: the young stay inside, and the old go out.⟧</p><p>⟦When many foragers are lost, younger ones take their place within a day.⟧</p></div><div class="foot">Herald press <a href=/i>Imprint</a></div></body>',
    '<body><nav><a href=/>Wiki</a></nav><main><h1>⟦Rivers of the north⟧</h1><p>⟦The north has four large rivers, which all flow to the west.⟧</p><p>⟦<a href=/a>The Alde⟧</a></p><p>⟦<a href=/b>The Bren⟧</a></p><p>⟦Only the last of them carries ships, and only as far as the first falls.⟧</p></main><footer>Text is free to use. <a href=/l>Licence</a></footer></body>',
    # comments and odd markup
    '<body><div class="bar"><a href=/>Home</a><a href=/f>Food</a></div><article><h1>⟦Soup for ten⟧</h1><p>⟦Cut the onions and let them turn golden in butter, which takes a quarter of an hour.⟧</p><!-- a note <b>inside</b> --><p>⟦Add the broth and cook everything until it is soft.⟧</p></article><div class="comments"><p>I made this for my family last week and all of them wanted more.</p><p>Can it be frozen for later?</p></div><!-- end</body>',
    '<body><ul><li><a href=/>Start</a><li><a href=/h>Haus</a><li><a href=/g>Garten</a></ul><div class="werbung">Jetzt Möbel kaufen und sparen!</div><div class="artikel"><h1>⟦Der Keller bleibt trocken⟧</h1><p>⟦Wer den Keller im Sommer lüftet, holt sich die Feuchtigkeit erst ins Haus.⟧</p><p>⟦Besser ist es, die Fenster nur in kühlen Nächten zu öffnen.⟧</p></div><div id="fuss">Impressum und Datenschutz</div></body>',
    '<body><header><a href=/>Books</a></header><main><h1>⟦A quiet novel⟧</h1><p>⟦The novel follows a postman through one long winter in which hardly anything happens.⟧</p><p>⟦It is the snow that changes, and with it the way he sees the houses.⟧</p></main><section class="reviews"><h3>Reviews by readers</h3><p>I fell asleep twice but in the end I loved every page of this book.</p><p>Not for me, too slow and too cold.</p></section></body>',
    # plain structure without names
    '<body><div><a href=/1>Home</a> <a href=/2>Projects</a> <a href=/3>Mail</a></div><div><h2>⟦A clock without hands⟧</h2><p>⟦I built this clock from an old turntable and a lamp that shines through a slit.⟧</p><p>⟦The shadow on the wall moves once around in twelve hours.⟧</p><p>⟦Plans are free for everyone who wants to try.⟧</p></div><div><a href=/4>Next</a> | <a href=/5>Previous</a></div></body>',
    '<body><table><tr><td><a href=/a>Index</a><br><a href=/b>Search</a></td><td><font size=4>⟦Repairing a violin⟧</font><br><br>⟦A crack in the top has to be closed from the inside, with small pieces of spruce across the grain.⟧<br><br>⟦Warm glue holds them, and it can be opened again in a hundred years.⟧</td></tr></table></body>',
    '<body>⟦This letter was found in a wall when the house was pulled down, and it is printed here as it was.⟧<br><br>⟦Dear sister, the harvest is in and we are all well.⟧<br><br>⟦The winter will be long, but we have wood and flour.⟧</body>',
    '<body><p><a href=/u>Up</a></p><h1>⟦How to sharpen a knife⟧</h1><p>⟦Hold the blade flat against the stone and raise its back by the width of two coins.⟧</p><ol><li>⟦Draw it towards you ten times.⟧</li><li>⟦Turn it and push it away ten times.⟧</li><li>⟦Wipe it dry.⟧</li></ol><p>⟦A sharp knife cuts a sheet of paper by its own weight.⟧</p><hr><p><a href=/n>Next page</a></p></body>',
    '<body><div><div><a href=/>Portal</a></div></div><div><div>⟦The market opens at six, when the first boats come in with their crates.⟧</div><div>⟦By nine the best fish is gone, and the stalls begin to close.⟧</div><div>⟦Cooks from the big hotels come early and pay what is asked.⟧</div></div><div><div><a href=/t>Terms</a></div></div></body>',
    # languages
    '<body><div class="menu"><a href=/>Accueil</a><a href=/c>Cuisine</a></div><div class="publicite">Nos offres de la semaine</div><div class="texte"><h1>⟦Le pain de seigle⟧</h1><p>⟦La pâte doit reposer toute une nuit au frais avant d\'être mise au four.⟧</p><p>⟦Le lendemain, on la façonne et on la laisse lever encore une heure.⟧</p></div><div class="pied">Mentions légales</div></body>',
    '<body><nav><a href=/>Inicio</a><a href=/d>Deportes</a></nav><main><h1>⟦La carrera de los faros⟧</h1><p>⟦Cada verano los corredores unen los cinco faros de la costa en una sola noche.⟧</p><p>⟦El más rápido tardó menos de siete horas, y llegó cuando amanecía.⟧</p></main><section class="comentarios"><p>Yo corrí el año pasado y terminé con los pies destrozados.</p></section><footer>Aviso legal</footer></body>',
    '<body><div id="kop"><a href=/>Krant</a></div><div id="inhoud"><h1>⟦De dijk is klaar⟧</h1><p>⟦Na drie jaar werk is de nieuwe dijk klaar, en het water kan nu een meter hoger komen.⟧</p><p>⟦De boeren achter de dijk zijn blij, want hun land stond vaak onder water.⟧</p></div><div id="voet">Contact en privacy</div></body>',
    '<body><div class="header"><a href=/>Вести</a></div><div class="content"><h1>⟦Музей открылся снова⟧</h1><p>⟦После ремонта музей снова принимает гостей, и в первый же день пришло больше тысячи человек.⟧</p><p>⟦В новых залах показывают старые карты и приборы.⟧</p></div><div class="footer"><a href=/k>Контакты</a></div></body>',
    '<body><nav><a href=/>ホーム</a><a href=/n>ニュース</a></nav><article><h1>⟦古い駅舎が図書館に⟧</h1><p>⟦使われなくなった駅舎が、来月から町の図書館として生まれ変わることになりました。⟧</p><p>⟦待合室だった部屋には、鉄道の本が並びます。⟧</p></article><footer>お問い合わせ</footer></body>',
    '<body><div class="top"><a href=/>أخبار</a></div><article><h1>⟦افتتاح الحديقة⟧</h1><p>⟦افتتحت المدينة أمس حديقة جديدة على ضفة النهر بعد عامين من العمل المتواصل.⟧</p><p>⟦يمكن للزوار أن يستأجروا قوارب صغيرة في عطلة نهاية الأسبوع.⟧</p></article><footer>اتصل بنا</footer></body>',
    # wrappers, forms, frameworks
    '<body><form action=/ id="aspnet"><div class="toolbar"><a href=/l>Log in</a><input><button>Search</button></div><div class="main-column"><h1>⟦Waste is collected later⟧</h1><p>⟦Because of the holiday the bins are emptied on Thursday instead of Wednesday in all districts.⟧</p><p>⟦Please put them out by six in the morning.⟧</p></div><div class="links"><a href=/a>All services</a><a href=/b>Forms</a></div></form></body>',
    '<body><div id="root"><div class="css-1ab"><div class="css-2cd"><a href=/>Feed</a><a href=/p>People</a></div><div class="css-3ef"><h1 class="css-4">⟦Why my tests were slow⟧</h1><div class="css-5">⟦Every test started a database of its own, and stopping it took longer than the test.⟧</div><div class="css-5">⟦Now they share one and roll back what they wrote, which is ten times as fast.⟧</div></div><div class="css-6"><a href=/s>Share</a></div></div></div></body>',
    '<body><div class="container"><div class="row"><div class="col-3"><ul><li><a href=/1>Intro</a></li><li><a href=/2>Setup</a></li><li><a href=/3>Usage</a></li></ul></div><div class="col-9"><h1>⟦Setup⟧</h1><p>⟦Unpack the archive into an empty folder and open a terminal there.⟧</p><pre>⟦make all⟧</pre><p>⟦The first build takes some minutes, later ones are quick.⟧</p><h2>⟦Problems⟧</h2><p>⟦If the compiler is missing, install it first and try again.⟧</p></div></div></div></body>',
    '<body><div class="cookie-banner">We use cookies to improve your visit. <button>OK</button></div><div class="site"><header class="site-header"><a href=/>Garden club</a></header><div class="entry-content"><h2>⟦Plant garlic in autumn⟧</h2><p>⟦Garlic that is planted in October has strong roots before the frost comes.⟧</p><p>⟦Push each clove into the soil with the tip up, a hand apart.⟧</p><div class="ad-slot">Seeds at half price, order today</div><p>⟦In July the leaves turn yellow, and the bulbs can be lifted.⟧</p></div><div class="newsletter">Sign up for our letter</div></div></body>',
    '<body><div class="page-wrap"><div class="breadcrumb"><a href=/>Home</a> &gt; <a href=/s>Science</a></div><section class="post"><h1>⟦Ice that burns⟧</h1><p class="lead">⟦Deep under the sea lies ice that holds gas, and it burns when lit.⟧</p><p>⟦It forms where water is cold and the pressure is high.⟧</p><figure><img src=i.png><figcaption>⟦A piece of it burning in a bowl.⟧</figcaption></figure><p>⟦How much of it there is, nobody knows.⟧</p></section><section class="related"><h3>Related stories</h3><ul><li><a href=/1>Gas from mud</a></li></ul></section></div></body>',
    '<body><main><article><header><h1>⟦Night trains return⟧</h1><p>⟦Five new lines are planned for the coming year.⟧</p></header><p>⟦The trains leave in the evening and reach the coast before breakfast, with beds for every budget.⟧</p><h2>⟦Prices⟧</h2><table><tr><th>⟦Seat⟧</th><td>⟦from 30⟧</td></tr><tr><th>⟦Bed⟧</th><td>⟦from 70⟧</td></tr></table><p>⟦Tickets go on sale in spring.⟧</p></article></main><aside class="sidebar"><h3>Most read</h3><ol><li><a href=/1>Delays</a></li><li><a href=/2>Strikes</a></li></ol></aside></body>',
    '<body><div id="page"><div id="header"><h1><a href=/>The Daily Walker</a></h1><p>Notes from the road</p></div><div class="entry"><h2>⟦Rain all day⟧</h2><p>⟦It rained from the moment we left the hut until we reached the next one.⟧</p><p>⟦Still, it was a good day, because the forest smelled of moss.⟧</p></div><div id="comments"><ol class="commentlist"><li>Sounds just like our trip two years ago, we were soaked to the skin.</li><li>Which hut was it?</li></ol></div></div></body>',
    '<html><head><title>Page</title><body><div class="nav"><a href=/>Home</a></div><div class="body"><p>⟦The first mill on this brook was built by monks, who needed flour and had time.⟧<p>⟦Two floods took it away, and each time they built it again a little higher.⟧<p>⟦Today its wheel turns only on Sundays.⟧</div></html>',
    '<body><div role="navigation"><a href=/>Home</a></div><div role="main"><h1>⟦Painting with coffee⟧</h1><p>⟦Strong coffee makes a brown that no paint box has, and it does not fade for years.⟧</p><p>⟦Let every layer dry before the next one.⟧</p></div><div role="complementary"><p>Our course starts in May, book your place now.</p></div><div role="contentinfo">Imprint</div></body>',
    '<body><div class="mw"><h1>⟦Lighthouse⟧</h1><p>⟦A <b>lighthouse</b> is a tower with a <a href=/l>lamp⟧</a>⟦ that shows <a href=/s>ships⟧</a>⟦ the way at night.⟧</p><h2>⟦History⟧</h2><p>⟦The first ones were open <a href=/f>fires⟧</a>⟦ on hills, which were kept by <a href=/m>monks⟧</a>⟦ in many places.⟧</p><p>⟦Later, oil lamps with <a href=/r>mirrors⟧</a>⟦ took their place.⟧</p></div><div class="catlinks"><a href=/c1>Towers</a> <a href=/c2>Ships</a></div></body>',
    '<body><div class="shop-nav"><a href=/k>Knives</a> <a href=/p>Pans</a> <a href=/c>Cart</a></div><div class="guide"><h1>⟦Which pan for what⟧</h1><h3>⟦Iron⟧</h3><p>⟦Iron pans get hot slowly but hold the heat, so they are right for meat.⟧</p><h3>⟦Copper⟧</h3><p>⟦Copper follows the flame at once and is best for sauces.⟧</p><h3>⟦Steel⟧</h3><p>⟦Steel forgives everything, even the dishwasher.⟧</p></div><div class="promo">Free delivery on all orders this week</div></body>',
    '<body><header><nav><a href=/>Q and A</a><a href=/n>New</a></nav></header><main><h1>⟦Why is the sky dark at night?⟧</h1><p>⟦If there are stars in every direction, each line of sight should end on one, and the night should be bright.⟧</p><p>⟦It is dark because the light of most stars has not had time to reach us.⟧</p></main><div class="respond"><h3>Leave a reply</h3><form><label>Name</label><input><textarea></textarea></form></div></body>',
    '<body><center><a href=/>News</a> - <a href=/o>Old news</a></center><hr><center><b>⟦Town elects a goat⟧</b></center><blockquote>⟦For the third time a goat has won the vote for the honorary mayor, with more than half of all votes.⟧<p>⟦It will open the summer fair and may eat the flowers afterwards.⟧</blockquote><hr><center><small>Webmaster: Bob</small></center></body>',
    '<body><div class="slider"><a href=/1>Top story</a><a href=/2>Second story</a></div><div class="news-item"><h1>⟦Library lends tools⟧</h1><div class="meta">12 May</div><div class="news-text">⟦Drills, saws and ladders can now be borrowed at the library, just like books.⟧<br>⟦Whoever brings them back late pays a small fee.⟧<br>⟦The tools were given by a shop that closed.⟧</div></div><div class="box">Weather today: sun</div></body>',
    '<body><div class="wrapper"><div class="content"><h1>⟦Letters to the editor, 1902⟧</h1><p>⟦The archive has put a hundred letters online that readers sent to the paper long ago.⟧</p><p>⟦They complain about noise, dust and the price of milk, and most of them are funny.⟧</p></div><div class="discussion"><h4>3 comments</h4><p>My great aunt wrote one of these letters, I found her name in the list!</p><p>Milk was cheaper then.</p><p>Thanks for putting this online.</p></div></div><footer>Archive, open on weekdays</footer></body>',
]
