"""Main text of web pages: the maximum-scoring run of words and tags.

A page is a sequence of words and tags. Words score by the block they stand in (its length, how much of it is linked, whether it ends like a sentence, its
kind of element and the part of the page around it), tags score negative by their kind; a scan that remembers the best run so far finds the contiguous region with
the highest sum. What lies inside the region belongs to the text.

Left out of the region are parts that are boilerplate of their own: elements whose kind, name (class, id, role) and content look like menus, notices, adverts
or reader comments. A name alone empties no page: parts are taken for boilerplate one after the other, the clearest first, and only while enough running
text remains outside of them. ``html``, ``body`` and elements around the whole text are never judged by their name.

All weights are fitted on the labelled pages below: logistic regressions of blocks and of elements, and log odds of tags. Each page counts in three versions: as it is, without
names, and with plain ``div`` for elements that tell their purpose, so that structure has to carry the decision where names are missing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches_of, exactly

# Elements that never hold text of an article, and those that do not end a block.
SILENT = {"script", "style", "noscript", "template", "head", "title", "textarea", "select", "option", "button", "iframe", "svg", "canvas", "object", "audio", "video", "datalist", "dialog"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Formulas are text of their paragraph.
INLINE |= {"math", "mi", "mn", "mo", "mrow", "msup", "msub", "mfrac", "msqrt", "mtext", "semantics"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: All that may stand in a head: its end tag can be left out, so any other start tag and any text end it.
IN_HEAD = {"html", "title", "meta", "link", "base", "basefont", "bgsound", "style", "script", "noscript", "noframes", "template"}
#: Elements that tell the purpose of what is in them, the innermost one counts.
PARTS = {"article", "main", "nav", "header", "footer", "aside", "form", "menu", "fieldset", "address"}
KINDS = {"p": "text", "blockquote": "text", "pre": "text", "dd": "text", "figcaption": "caption", "caption": "caption", "li": "item", "dt": "item", "td": "cell", "th": "cell", "h1": "title", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading"}
#: Text directly in one of these is closed by the next of the same kind.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NAMES = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
_SENTENCE = re.compile(r"[.!?:;…。！？；：؟।][\"'»”’)\]]*$")
_WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\u0e00-\u0e7f]")
#: A run of words this long reads like running text.
RUNNING = 8
#: Outside a part that is left out, so many running words must remain, and this share of its own.
REMAINS, REMAINING_SHARE = 20, 0.2
#: Elements nested deeper than this count as part of the one around them, as in browsers.
DEEPEST = 512

# Labelled pages (fixed values). Elements marked data-main hold the article; data-not marks what inside them does not belong to it.
LABELLED = [
    """<html><body><header class="site-header masthead"><a href=/>Daily News</a><p>All the news of the town</p></header><nav class="menu navbar"><ul><li><a href=/a>Home</a></li><li><a href=/b>World</a></li><li><a href=/c>Sport</a></li></ul></nav>
    <div class="ad advert banner">Buy new shoes today for half the price</div><article data-main><h1>Rain stops the harvest in the north</h1><p>Farmers in the north have had to stop the harvest after two weeks of rain, and many fear for the crop.</p><p>The <b>ministry</b> said on Monday that help is on its way.<br>More will follow in the days to come.</p></article>
    <footer class="footer">&copy; 2020 Daily News. All rights reserved. <a href=/i>Imprint</a></footer></body></html>""",
    """<html><body><div id="cookie-notice" class="cookie consent banner notice">We use cookies to make this site better. <button>Accept</button></div><div class="topbar header"><a href=/l>Log in</a> <a href=/r>Register</a></div>
    <div class="content"><div class="post" data-main><h2>How to bake bread at home</h2><p>Bread needs flour, water, salt and time, and little else besides.</p><ul><li>Mix the flour with the water and wait for an hour.</li><li>Add the salt and knead until the dough is smooth.</li></ul><blockquote>Good bread cannot be hurried, as my mother used to say.</blockquote><p>Bake it in a hot oven until the crust is brown.</p></div></div>
    <aside class="sidebar widget"><h3>Popular posts</h3><ul><li><a href=/1>Ten soups</a></li><li><a href=/2>Cakes for all</a></li></ul><p>Sign up for our letter</p></aside>
    <section id="comments" class="comments comment-list reader"><h3>Comments</h3><div class="comment reply"><p>Thank you, that was the best loaf I ever made.</p></div><div class="comment"><p>Mine did not rise, what did I do wrong?</p></div></section><footer><p>Contact and imprint</p></footer></body></html>""",
    """<html><body><nav><a href=/>Start</a> <a href=/x>Archive</a></nav><div class="breadcrumbs breadcrumb"><a href=/>Home</a> &gt; <a href=/s>Science</a></div><main data-main><h1>A new moon found near the planet</h1><p>Astronomers have seen a small moon that had been hidden in the glare of the planet for years.</p>
    <div class="promo sponsored ad" data-not>Telescopes on sale this week only</div><p>It is only a few miles across and circles the planet in less than a day, they write.</p><figure><img src=m.jpg><figcaption>The moon as the probe saw it in spring.</figcaption></figure><h3>More to come</h3><p>Other moons may follow, since only half of the pictures have been looked at so far.</p>
    <aside class="related" data-not><h4>Related</h4><a href=/m>Moons and rings</a></aside></main><form class="newsletter subscribe signup" action=/n><p>Subscribe to our newsletter and never miss a story again</p><input><label>Your mail</label></form><footer class="site-footer copyright">Copyright by the paper</footer></body></html>""",
    """<html><body><div class="menu"><ul><li><a href=/1>One</a><li><a href=/2>Two</a><li><a href=/3>Three</a></ul></div><div class="share social">Share this page with your friends</div><div id="main" class="entry text body" data-main><p>The old bridge over the river was built by hand more than three hundred years ago.</p><h3>A second life</h3><h4>Walkers and carts</h4><p>Today it carries only walkers, but the town wants to open it to <a href=/w>carts</a> again.</p><table><tr><td>Length</td><td>forty paces</td></tr><tr><td>Width</td><td>six paces</td></tr></table><p>Work will begin after the winter.</p></div>
    <div class="discussion respond disqus"><p>I cross it every morning and hope that it stays as it is.</p><p>Carts have no place there at all, if you ask me.</p></div><div class="login search form">Search this site</div></body></html>""",
    """<html><body><div role="banner" class="head"><p>The weekly paper for friends of the sea</p></div><div role="navigation"><a href=/>Home</a><a href=/z>Ships</a></div><div class="page" role="main" data-main><h1>The last lighthouse keeper</h1><p>For thirty years she lit the lamp each evening, and in all that time no ship was lost on the rocks below.</p><p>Now a machine does the work, and the house stands empty.</p><ol><li>The lamp was first lit with oil.</li><li>Later it burned gas.</li></ol></div><div role="complementary" class="side rail"><p>Read more stories of the coast in our book</p></div>
    <div class="popup modal overlay alert notice warning" role="alert">Your trial ends soon, renew it now</div><div role="contentinfo" class="legal disclaimer">Terms of use and privacy</div><div class="advertisement ads sponsor banner">Cheap trips to the islands</div></body></html>""",
    """<html><body><div>The Journal</div><div><a href=/a>News</a> | <a href=/b>Sport</a> | <a href=/c>Weather</a> | <a href=/d>Mail</a></div><div data-main><div>The council has voted to plant a thousand trees along the main roads of the city before the end of the year.</div><div>Oaks and limes were chosen since they stand heat well, the head gardener told us.</div><div>Residents may give names to the trees.</div></div><div><a href=/t>Terms</a> | <a href=/p>Privacy</a></div></body></html>""",
    """<html><body><header><h1>The Garden Page</h1><p>News for gardeners</p></header><article data-main><header class="entry-header"><h1>When to cut roses</h1></header><p>Roses are cut when the forsythia blooms, and not before, for late frost harms the fresh shoots.</p><h3>Tools</h3><p>A sharp pair of shears is all that is needed for it.</p><pre>cut above the bud</pre><div class="comments" data-not><h3>What readers say</h3><p>I always cut mine in autumn and they bloom all the same.</p></div></article><aside><p>Seeds and bulbs by post</p></aside><section class="comments feedback"><p>Nice page, I will come back to it next year.</p></section><footer><nav><a href=/>Top</a></nav></footer></body></html>""",
    """<body><div id="kopf" class="kopf logo"><a href=/>Der Bote</a></div><ul id="navi"><li><a href=/p>Politik</a></li><li><a href=/k>Kultur</a></li></ul><div class="werbung anzeige">Jetzt neu: Schuhe zum halben Preis bestellen!</div><div id="inhalt" data-main><h1>Der Fluss steigt weiter</h1><p class="vorspann">Nach tagelangem Regen steht das Wasser in den unteren Gassen der Altstadt.</p><p>Die Feuerwehr füllt Säcke mit Sand, und viele Bewohner helfen mit. Am Abend soll der höchste Stand erreicht sein.</p><p>Schon vor zehn Jahren war die Brücke überflutet worden.</p></div><div class="kommentare"><h3>Kommentare</h3><p>Bei uns im Keller stand das Wasser schon gestern einen halben Meter hoch.</p><p>Danke an alle, die dort helfen!</p></div><div id="fuss" class="fusszeile">Impressum und Datenschutz. Alle Rechte vorbehalten.</div></body>""",
    """<body><div class="entete"><a href=/>Le Courrier</a> <a href=/a>Accueil</a> <a href=/b>Sports</a></div><div class="publicite">Voyagez moins cher cet hiver avec nos offres</div><div class="contenu"><h1 data-main>Le village sans voitures</h1><p data-main>Depuis le printemps, les habitants laissent leur voiture à l'entrée du village et marchent jusqu'à leur maison.</p><p data-main>« On entend de nouveau les oiseaux », dit la boulangère, qui livre maintenant son pain à vélo.</p><ul data-main><li><a href=/c1>La carte du village</a></li><li><a href=/c2>Les horaires des navettes</a></li></ul><p data-main>Le maire veut garder cette règle pendant trois ans, puis demander leur avis aux habitants.</p></div><div class="commentaires avis"><p>Bravo, il faudrait faire la même chose dans toutes les communes de la vallée !</p><p>Et comment font les personnes âgées pour porter leurs courses ?</p></div><div class="pied mentions">Mentions légales - Contact - Plan du site</div></body>""",
    """<body><div class="cabecera"><a href=/>Inicio</a> | <a href=/n>Noticias</a></div><div class="lateral barra"><h4>Lo más leído</h4><ol><li><a href=/1>Diez playas</a></li><li><a href=/2>La receta del día</a></li></ol></div><section class="cuerpo noticia" data-main><h1>Vuelven las cigüeñas al campanario</h1><p>Las cigüeñas han vuelto este año dos semanas antes de lo normal, según cuenta el párroco del pueblo.</p><p>Los vecinos las reciben como señal de buena suerte. Los niños de la escuela han contado ya once nidos.</p></section><section class="comentarios opiniones"><p>En mi pueblo también llegaron antes, será por el calor que ha hecho.</p></section><div class="aviso cookies">Usamos cookies propias y de terceros para mejorar la página.</div><div class="pie">Aviso legal y contacto</div></body>""",
    """<body><div><div><a href=/a>Home</a><a href=/b>Blog</a><a href=/c>About</a></div></div><div class="legal"><h2 data-main>What a tenant may change</h2><p data-main>A tenant may paint the walls and drill holes of a usual size, but has to close them before moving out.</p><p data-main>Whoever wants to remove a wall needs the written consent of the owner, and should ask for it early.</p><p class="notice" data-main>Notice must be given three months before the end of the term, in writing and with a signature.</p><div id="side-effects" data-main><h3>Side effects of a change</h3><p>Changes can raise the rent if they make the flat worth more, which a court will decide in doubt.</p></div><p class="social" data-main>Social clauses protect those who are old or ill, and they can stay on for longer.</p></div><div>Written by a lawyer. All rights reserved.</div></body>""",
    """<body class="page menu-open"><div class="wrapper"><div class="col"><a href=/x>First</a> <a href=/y>Second</a> <a href=/z>Third</a></div><div class="col"><table><tr><td data-main><b>The clock tower</b><br>The clock tower was built when the railway came, so that nobody would miss a train.<br><br>It has four faces, and for years each of them showed another time.<br>A clockmaker from the next town set them right at last.</td></tr></table></div><div class="col"><a href=/q>Forum</a><br>Visitors so far: 1204<br>Last change in May</div></div></body>""",
    """<body><header role="banner"><a href=/>Tech Notes</a></header><main data-main><h1>Reading a file line by line</h1><p>Most programs do not need the whole file at once, and reading it by lines keeps memory low.</p><pre>with open(name) as lines:
    for line in lines:
        print(line)</pre><p>The loop ends by itself at the end of the file; nothing has to be closed by hand.</p><p>See also:</p><ul><li><a href=/1>Writing files</a></li><li><a href=/2>Text and bytes</a></li></ul><table><tr><th>Mode</th><th>Meaning</th></tr><tr><td>r</td><td>read</td></tr><tr><td>w</td><td>write</td></tr></table><p>Open files in text mode unless there is a reason not to.</p></main><div class="reviews rating"><p>Five stars, this helped me a lot with my homework.</p><p>Too short, I had hoped to learn more about errors.</p></div><footer role="contentinfo"><p>Made with care. <a href=/i>Imprint</a></p></footer></body>""",
    """<body><div id="top">Free shipping on all orders above fifty! <a href=/s>Shop now</a></div><div class="post-meta byline">By <a href=/w>Will</a>, 3 May</div><div class="post-body" data-main><p>It took us three days to walk around the lake, and we met nobody on the way but two fishermen.</p><p>On the second night it rained so hard that the tent gave way, and we slept in a boat house.</p><blockquote>Nobody walks here any more, said the older one, they all drive to the bridge.</blockquote><p>The path is marked in blue. Take water with you.</p></div><div class="tags"><a href=/t1>walks</a> <a href=/t2>lakes</a></div><div class="share-buttons"><a href=/f>Share</a> <a href=/m>Mail</a></div><div class="related-posts"><h3>You may also like</h3><p><a href=/o>The long way to the coast</a></p><p><a href=/u>Under the old bridge</a></p></div><div id="respond" class="comment-form"><h3>Leave a reply</h3><p>Your mail address will not be published.</p></div></body>""",
    """<body><nav><ul><li><a href=/>首页</a></li><li><a href=/n>新闻</a></li></ul></nav><article data-main><h1>老桥重新开放</h1><p>经过两年的修复，城南的老桥昨天重新向行人开放，许多居民一早就来到桥上散步。</p><p>工程负责人说，桥面的石板全部保留了下来，只更换了损坏的部分。</p></article><section class="comments"><p>小时候每天上学都要走这座桥，真怀念。</p></section><footer><p>版权所有 联系我们</p></footer></body>""",
    """<body><div class="шапка header"><a href=/>Вести</a></div><div class="menu"><a href=/1>Город</a> <a href=/2>Спорт</a> <a href=/3>Погода</a></div><div class="text" data-main><h1>В парке посадили сто лип</h1><p>Жители района посадили в старом парке сто молодых лип, которые подарил питомник.</p><p>Первые деревья зацветут через пять лет, обещают садовники. За ними будут ухаживать школьники.</p></div><div class="reklama banner">Окна и двери со скидкой до конца месяца!</div><div class="comments otzyvy"><p>Хорошее дело, давно пора было это сделать, спасибо всем.</p></div><div class="footer">Все права защищены</div></body>""",
    """<body><form id="page" action=/><div class="toolbar"><a href=/l>Log in</a> <a href=/h>Help</a></div><div id="content-area" data-main><h1>Opening hours of the archive</h1><p>The archive is open to readers from Monday to Thursday, from nine in the morning until four.</p><p>Files have to be ordered two days ahead, and copies can be made for a small fee.</p><dl><dt>Phone</dt><dd>The desk answers calls in the morning only.</dd></dl></div><div class="search-box"><label>Search</label><input></div></form><div id="footer-links"><a href=/a>Access</a> <a href=/b>Privacy</a></div></body>""",
    """<body><aside class="left"><h4>Topics</h4><a href=/1>Birds</a><a href=/2>Trees</a></aside><div role="main" data-main><h1>Why owls fly without a sound</h1><figure><img src=o.jpg><figcaption>An owl at dusk, seen from below.</figcaption></figure><p>The front edge of an owl's wing is fringed like a comb, which breaks the air into small streams.</p><p>Soft down on the upper side swallows what noise is left.</p><aside class="pull-quote">Mice hear the owl when it is too late.</aside><p>Engineers have copied the fringe for the blades of fans.</p></div><div class="newsletter-box"><h4>Our letter</h4><p>Get the best of our stories each week, free and without adverts.</p></div><div class="popup gdpr" role="dialog"><p>We and our partners store data on your device. You can change your choice at any time.</p></div></body>""",
]


# Parts of further labelled pages (fixed values): sentences and headings of articles, and by language what stands around them and how its elements are named.
SENTENCES = [
    "The ferry leaves the island twice a day in summer and once in winter.", "Nobody had expected so many people to come.", "It is open again.", "She learned the trade from her grandfather, who had built boats all his life, and she has not looked back since.", "What is left of the wall can be seen from the road.", "He laughed, and went on with his work.", "Die Mühle steht seit dem letzten Winter still, weil das Rad gebrochen ist.",
    "Wer sie sehen will, muss früh aufstehen.", "Niemand wusste davon.", "Les premiers trains ont circulé dès le lendemain, malgré la neige tombée pendant la nuit.", "Personne ne l'avait vu venir.", "La cosecha de este año será mejor que la del año pasado, dicen los agricultores.", "Todo empezó con una carta.", "Il ponte fu costruito in soli due anni da operai venuti dalle montagne.", "De brug gaat elke dag om negen uur open voor de schepen.", "Мастер чинит часы в этой лавке уже сорок лет, и к нему приходят со всего города.",
]
HEADINGS = ["A quiet start", "The way back", "Ein neuer Anfang", "Les années difficiles", "What comes next", "La vuelta", "In the workshop"]
REPLIES = ["I have been there last week and can only agree with every word.", "Thank you!", "Das stimmt so nicht, ich wohne seit Jahren in der Straße.", "Très bel article, merci beaucoup à vous.", "No estoy de acuerdo con lo que dice el autor.", "First comment here, great story as always."]
LINKS = ["Home", "News", "Sport", "Weather", "Archive", "Startseite", "Über uns", "Accueil", "Contacto", "Shop", "Log in", "Read more about it", "All stories"]
AROUND = [
    # menu, header, notice, advert, sidebar, comments, footer: names; then the texts of notice, advert, footer
    ("menu nav navigation", "header masthead top banner", "cookie notice consent banner", "ad advert advertisement promo sponsor", "sidebar widget related complementary", "comments comment discussion respond reviews replies", "footer copyright legal imprint contentinfo", "We use cookies on this site. Accept", "Buy now and save half the price", "All rights reserved"),
    ("navi menue hauptmenue", "kopf kopfzeile logo", "hinweis cookie meldung", "werbung anzeige reklame", "seitenleiste rand spalte", "kommentare leserbriefe kommentar meinungen", "fuss fusszeile impressum", "Diese Seite benutzt Cookies.", "Jetzt bestellen und sparen", "Impressum Datenschutz"),
    ("menu navigation barre", "entete tete bandeau", "avis bandeau cookies", "publicite pub annonce", "colonne lateral", "commentaires reactions avis", "pied mentions bas", "Nous utilisons des cookies.", "Profitez de nos offres", "Mentions légales"),
    ("menu navegacion", "cabecera encabezado", "aviso cookies", "publicidad anuncio", "lateral barra", "comentarios opiniones", "pie aviso legal", "Usamos cookies propias y de terceros.", "Compre ahora con descuento", "Aviso legal"),
]
CONTENT = ["content", "post", "entry", "article body", "text main", "inhalt beitrag artikel", "contenu texte", "contenido noticia cuerpo", "story", "page"]


def made_pages(n: int) -> Iterator[str]:
    """Labelled pages put together from the parts above, the same in every run: how articles are set, which elements are used, what stands where."""
    for k in range(n):
        pick = np.random.default_rng(k)
        some = lambda pool, m: [pool[i] for i in pick.integers(0, len(pool), m)]  # noqa: E731, B023
        menu, head, notice, advert, side, replies, foot, note, offer, rights = AROUND[k % len(AROUND)]
        named = k % 3 > 0
        name = lambda names, named=named, pick=pick: f' {("class", "id")[int(pick.integers(2))]}="{" ".join(pick.permutation(names.split())[: 1 + int(pick.integers(3))])}"' if named else ""
        box = lambda tag, names, inner: f"<{tag}{name(names)}>{inner}</{tag}>"  # noqa: E731, B023
        parts = k % 4 < 2
        links = lambda m: some(LINKS, m)  # noqa: E731, B023
        if (named or parts) and pick.random() < 0.6:  # what stands around may read like an article, so that its place and names have to tell
            note, offer, rights = (x + " " + some(SENTENCES, 1)[0] if pick.random() < 0.5 else some(SENTENCES, 1)[0] for x in (note, offer, rights))
        rows = ["<ul>" + "".join(f"<li><a href=/>{x}</a></li>" for x in links(4)) + "</ul>", " | ".join(f"<a href=/>{x}</a>" for x in links(5)), "".join(f"<div><a href=/>{x}</a></div>" for x in links(3))]
        paragraph = ("p", "div", "p", "section", "p", "td")[k % 6]
        text = []
        for i in range(int(pick.integers(2, 7))):
            text.append(f"<{paragraph}>{' '.join(some(SENTENCES, int(pick.integers(1, 4))))}</{paragraph}>")
            extra = int(pick.integers(12))
            text += [f"<h3>{some(HEADINGS, 1)[0]}</h3>"] * (extra == 0) + ["<ul>" + "".join(f"<li>{x}</li>" for x in some(SENTENCES + HEADINGS, 3)) + "</ul>"] * (extra == 1)
            text += [f"<blockquote>{some(SENTENCES, 1)[0]}</blockquote>"] * (extra == 2) + [f"<figure><img src=x><figcaption>{some(SENTENCES, 1)[0]}</figcaption></figure>"] * (extra == 3)
            text += ["<ul>" + "".join(f"<li><a href=/>{x}</a></li>" for x in some(HEADINGS, 2)) + "</ul>"] * (extra == 4) + [f"<{'aside' if parts else 'div'} data-not{name(advert)}>{offer}</{'aside' if parts else 'div'}>"] * (extra == 5 and named)
            text += ["<table><tr><td>Height</td><td>12 m</td></tr><tr><td>Built in</td><td>1890</td></tr></table>"] * (extra == 6) + [f"<p>{some(SENTENCES, 1)[0]} <a href=/>{some(HEADINGS, 1)[0]}</a></p>"] * (extra == 7)
        title = f"<h1>{some(HEADINGS, 1)[0]}</h1>" * (k % 5 < 4)
        body = (f"<header>{title}</header>" if title and k % 8 == 1 else title) + "".join(text)
        body = f"<table><tr>{body}</tr></table>" if paragraph == "td" else body
        article = box(("article" if k % 4 == 1 else "main") if parts else "div", CONTENT[k % len(CONTENT)], body)
        article = re.sub(r"^<(\w+)", r"<\1 data-main", article)
        tags = ("nav", "header", "footer", "aside", "section") if parts else ("div",) * 5
        before = [box(tags[1], head, links(1)[0] + " " + some(HEADINGS, 1)[0]), box(tags[0], menu, rows[k % 3]), box("div", notice, note), box(tags[3], side, f"<h4>{some(HEADINGS, 1)[0]}</h4>" + rows[(k + 1) % 3])]
        answers = "".join(f"<{t}>{x}</{t}>" for x, t in zip(some(REPLIES, 4), ["p", "div", "li", "p"], strict=True)) if named else ""
        after = [box(tags[4], replies, answers)] if named else []
        after += [box("div", advert, offer), box(tags[3], side, rows[k % 3]), box(tags[2], foot, rights + " " + rows[1])]
        yield "<html><body>" + "".join(x for x in before if pick.random() < 0.7) + article + "".join(x for x in after if pick.random() < 0.8) + "</body></html>"


@dataclass
class Element:
    """An element that is not inline. ``part``: the innermost part of the page it is in or is; ``label``: that of training pages; ``last``: the last element in it."""

    tag: str
    names: frozenset
    parent: int
    part: str = "none"
    label: bool = False
    depth: int = 0
    last: int = 0
    words: int = 0
    linked: int = 0
    running: int = 0
    blocks: int = 0
    sentences: int = 0
    main: int = 0  # words labelled as article


@dataclass
class Block:
    """A run of text between two block tags. ``place``: its innermost element."""

    text: str
    place: int
    pieces: list[tuple[int, int]]  # words, and the anchor around them (-1: none)
    words: int = 0
    linked: int = 0
    sentence: bool = False
    near: int = 0  # how many of the blocks before and after it read like running text
    label: bool = False


def count_words(text: str) -> int:
    """Words; scripts without spaces count two characters as one."""
    wide = len(_WIDE.findall(text))
    return len(text.split()) + (wide // 2 - 1 if wide > 3 else 0)


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", frozenset(), -1)])
    events: list[Block | str] = field(default_factory=list)  # a block of text, or the name of a tag

    def blocks(self) -> Iterator[Block]:
        return (e for e in self.events if isinstance(e, Block))

    def around(self, place: int) -> Iterator[int]:
        """The element and all around it, innermost first."""
        while place >= 0:
            yield place
            place = self.elements[place].parent

    def holds(self, i: int, j: int) -> bool:
        """Whether element ``j`` is element ``i`` or in it. Elements are numbered as they begin."""
        return i <= j <= self.elements[i].last

    def sums(self, of_place: dict[int, int]) -> list[int]:
        """For each element, the sum over itself and all in it."""
        out = [of_place.get(i, 0) for i in range(len(self.elements))]
        for i in range(len(out) - 1, 0, -1):
            out[self.elements[i].parent] += out[i]
        return out


class Reader(HTMLParser):
    """Reads a page as browsers do where tags are missing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.stack: list[tuple[str, int]] = []  # open tags, with the element each stands in or is
        self.text: list[tuple[str, int]] = []
        self.silent = 0
        self.anchor, self.anchors, self.closed = -1, 0, set()
        self.first_block: dict[int, int] = {}

    def place(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def flush(self) -> None:
        whole = "".join(t for t, _ in self.text)
        if whole.strip():
            pieces = [(count_words(t), link) for t, link in self.text if t.strip()]
            block = Block(" ".join(whole.split()), self.place(), pieces)
            block.label = self.page.elements[block.place].label
            for _, link in pieces:
                self.first_block.setdefault(link, len(self.page.events))
            self.page.events.append(block)
        self.text.clear()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE:
            self.flush()
            self.page.events.append(tag)
        if self.silent and tag not in IN_HEAD:
            self._end_head(anywhere=tag == "body")
        if tag in VOID:
            return
        if tag in SELF_CLOSING:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in SELF_CLOSING[tag]:
                    self._pop(i)
                    break
                if self.stack[i][0] not in INLINE:
                    break
        named = {k: v or "" for k, v in attrs}
        if tag == "a":  # an anchor ends the one before; without a target it is no link
            self.anchor = -1
            if "href" in named:
                self.anchors += 1
                self.anchor = self.anchors
        if tag in INLINE or self.page.elements[self.place()].depth >= DEEPEST:
            self.stack.append((tag, self.place()))
        else:
            names = frozenset(w.lower() for k in ("class", "id", "role") for w in _NAMES.findall(named.get(k, "")))
            around = self.page.elements[self.place()]
            label = "data-main" in named or (around.label and "data-not" not in named)
            part = around.part if tag not in PARTS else f"article {tag}" if tag in ("header", "footer") and around.part.startswith("article") else tag
            self.page.elements.append(Element(tag, frozenset() if tag in ("html", "body") else names, self.place(), part, label, around.depth + 1))
            self.stack.append((tag, len(self.page.elements) - 1))
        self.silent += tag in SILENT

    def _end_head(self, anywhere: bool = False) -> None:
        """Closes an open head; with elements open inside it only if ``anywhere``, and never from inside a template."""
        names = [tag for tag, _ in self.stack]
        if names[-1:] == ["head"] or (anywhere and "head" in names and "template" not in names):
            self._pop(names.index("head"))

    def _pop(self, upto: int) -> None:
        self.silent -= sum(tag in SILENT for tag, _ in self.stack[upto:])
        if any(tag not in INLINE for tag, _ in self.stack[upto:]) and any(tag == "a" for tag, _ in self.stack[upto:]):
            self.anchor = -1  # the element around the anchor ends
        del self.stack[upto:]

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
            self.page.events.append(tag)
        if tag == "a":
            self.closed.add(self.anchor)
            self.anchor = -1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return  # an inline end tag does not close blocks

    def handle_data(self, data: str) -> None:
        if self.silent and data.strip():
            self._end_head()
        if not self.silent:
            self.text.append((data, self.anchor))

    def finish(self) -> Page:
        self.flush()
        blocks = list(self.page.blocks())
        for at, block in enumerate(self.page.events):
            if isinstance(block, str):
                continue
            block.words = max(1, sum(n for n, _ in block.pieces))
            # An anchor without an end tag links the block it begins in, no more.
            block.linked = sum(n for n, link in block.pieces if link >= 0 and (link in self.closed or self.first_block[link] == at))
            block.sentence = bool(_SENTENCE.search(block.text))
            e = self.page.elements[block.place]
            e.words, e.linked, e.blocks = e.words + block.words, e.linked + block.linked, e.blocks + 1
            e.running += block.words - block.linked if block.words >= RUNNING else 0
            e.sentences, e.main = e.sentences + block.sentence, e.main + (block.words if block.label else 0)
        for i in range(len(self.page.elements) - 1, 0, -1):  # what is in an element is in those around it
            e, around = self.page.elements[i], self.page.elements[self.page.elements[i].parent]
            e.last = max(e.last, i)
            around.last = max(around.last, e.last)
            around.words, around.linked, around.blocks = around.words + e.words, around.linked + e.linked, around.blocks + e.blocks
            around.running, around.sentences, around.main = around.running + e.running, around.sentences + e.sentences, around.main + e.main
        runs = [b.words >= RUNNING and 3 * b.linked <= b.words for b in blocks]
        for i, block in enumerate(blocks):
            block.near = sum(runs[max(0, i - 1) : i] + runs[i + 1 : i + 2])
        return self.page


def read_page(html: str) -> Page:
    """An unclosed comment ends at the next ``>``."""
    open_comment = html.rfind("<!--")
    if open_comment >= 0 and html.find("-->", open_comment + 2) < 0:
        end = html.find(">", open_comment + 4)
        html = html[:open_comment] + (html[end + 1 :] if end >= 0 else "")
        return read_page(html)
    reader = Reader()
    reader.feed(html)
    reader.close()
    return reader.finish()


def _share(part: int, whole: int) -> str:
    share = part / max(whole, 1)
    return "none" if not part else "some" if share <= 0.3 else "half" if share <= 0.7 else "all"


def block_features(page: Page, block: Block) -> list[str]:
    """Running text is told by its length and end, all else by its element, links and neighbours too."""
    size, part = min(block.words.bit_length(), 6), page.elements[block.place].part
    if block.words >= RUNNING and block.linked <= 0.3 * block.words:
        return ["running", f"running {size}", f"running, sentence {block.sentence}", f"running, part {part}"]
    kind = KINDS.get(page.elements[block.place].tag, "other")
    linked = _share(block.linked, block.words)
    return [f"size {size}", f"sentence {block.sentence}", f"linked {linked}", f"kind {kind} {linked in ('half', 'all')}", f"part {part}", f"near {block.near}"]


def element_features(page: Page, place: int) -> list[str]:
    element = page.elements[place]
    tag = element.part if element.tag in PARTS else "other"
    size = min((element.words // max(element.blocks, 1)).bit_length(), 5)
    return [
        *(f"name {n}" for n in sorted(element.names)), f"tag {tag}", f"size {size}",
        f"linked {_share(element.linked, element.words)}", f"sentences {_share(element.sentences, element.blocks)}",
    ]


def regression(rows: list[tuple[list[str], bool, float]], strength: float, steps: int = 300) -> dict[str, float]:
    """Weights of a logistic regression on features that are there or not; ``strength`` pulls them to zero. Rows: features, label, weight."""
    names = {f: i for i, f in enumerate(sorted({f for fs, _, _ in rows for f in fs}))}
    x, y, w = np.zeros((len(rows), len(names) + 1)), np.array([float(label) for _, label, _ in rows]), np.array([w for *_, w in rows])
    x[:, -1] = 1
    for i, (fs, _, _) in enumerate(rows):
        x[i, [names[f] for f in fs]] = 1
    for side in (0.0, 1.0):  # both labels weigh the same
        w[y == side] /= w[y == side].sum() / len(rows)
    theta = np.zeros(len(names) + 1)
    pull = np.full(len(theta), strength)
    pull[-1] = 0
    for _ in range(steps):  # Newton's method, damped: few features, exact enough
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (w * (p - y)) + pull * theta
        if np.abs(gradient).max() < 1e-6:
            break
        theta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-9), gradient)
    return {f: float(theta[i]) for f, i in names.items()} | {"": float(theta[-1])}


def versions(page: str) -> list[str]:
    """A labelled page as it is, without names, and without names and with ``div`` for elements that tell their purpose."""
    nameless = re.sub(r"""\s(?:class|id|role)=(?:"[^"]*"|[^\s>]+)""", "", page)
    return [page, nameless, re.sub(rf"<(/?)(?:{'|'.join(sorted(PARTS))})\\b", r"<\1div", nameless)]


class Weights:
    """What the labelled pages say about blocks, elements and tags."""

    def __init__(self, pages: Iterable[str], strength: float = 1.0):
        read = [[read_page(v) for v in versions(text)] for text in pages]
        elements, blocks, tags = [], [], Counter()
        for page in (p for some in read for p in some[:2]):
            for i, e in enumerate(page.elements):  # those that are all article or all not, and hold something
                if i and e.words and e.main in (0, e.words) and (e.names or e.tag in PARTS):
                    elements.append((element_features(page, i), e.main > 0, 1.0))
        self.of_element = regression(elements, strength)
        for some in read:
            # Blocks have to tell what is left when boilerplate is out; without names that of the same text is not theirs to know either.
            known = {b.text for b in inside(some[0], left_out(some[0], self))}
            for page in some:
                main = False
                for event in page.events:
                    if isinstance(event, str):
                        tags[event, main] += 1
                    else:
                        main = event.label
                        if main or event.text not in known:
                            blocks.append((block_features(page, event), main, 1.0))
        self.of_block = regression(blocks, strength)
        totals = {side: sum(n for (_, s), n in tags.items() if s == side) for side in (True, False)}
        odds = lambda t: log((tags[t, True] + 1) / (totals[True] + 2)) - log((tags[t, False] + 1) / (totals[False] + 2))
        # Tags always cost something: the more, the more typical they are of the rest.
        self.tag = {t: max(-1.5, min(-0.1, odds(t) - 0.7)) for t in {t for t, _ in tags}}
        self.other_tag = -0.7

    def block(self, page: Page, block: Block) -> float:
        """Score of a block: that of a word times its words."""
        score = self.of_block[""] + sum(self.of_block.get(f, 0.0) for f in block_features(page, block))
        return block.words * min(2.0, max(-2.0, score))

    def element(self, page: Page, place: int) -> float:
        return self.of_element[""] + sum(self.of_element.get(f, 0.0) for f in element_features(page, place))


BARRIER = 8.0
MADE = 120


@lru_cache(maxsize=1)
def weights() -> Weights:
    return Weights([*LABELLED, *made_pages(MADE)])


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the highest sum; empty if none is above zero."""
    best, best_at, total, begin = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, best_at = total, (begin, i + 1)
    return best_at


def left_out(page: Page, model: Weights) -> set[int]:
    """Elements that are boilerplate of their own, with all that is in them."""
    said = {i: model.element(page, i) for i, e in enumerate(page.elements) if i and e.words and (e.names or e.tag in PARTS) and KINDS.get(e.tag) not in ("title", "heading")}
    parts, beyond = [], -1  # outermost article and main parts
    for i, e in enumerate(page.elements):
        if e.tag in ("article", "main") and i > beyond:
            parts.append(i)
            beyond = e.last
    parts.sort(key=lambda i: -page.elements[i].words)
    for i in parts:  # the article or main part of a page is not its boilerplate, only one inside another can be
        said.pop(i, None)
    out: set[int] = set()
    remaining = page.elements[0].running
    inside: dict[int, int] = Counter()  # running words of each element that are left out already
    for i in sorted((i for i, score in said.items() if score < 0), key=lambda i: (said[i], i)):
        if any(j in out for j in page.around(i)):
            continue
        own = page.elements[i].running - inside[i]
        least = 1 if page.elements[i].tag in PARTS or len(parts) == 1 else RUNNING  # several may be teasers
        elsewhere = any(page.elements[j].words >= least and not page.holds(i, j) and not page.holds(j, i) for j in parts)
        if own and not elsewhere and remaining - own < max(REMAINS, REMAINING_SHARE * own):
            continue  # the text itself, whatever its name
        out.add(i)
        remaining -= own
        for j in page.around(i):
            inside[j] += own
    return out


def inside(page: Page, places: set[int]) -> list[Block]:
    """Blocks in any of these elements."""
    gone = [False] * len(page.elements)
    for i, e in enumerate(page.elements):  # an element comes after the one around it
        gone[i] = i in places or (i > 0 and gone[e.parent])
    return [b for b in page.blocks() if gone[b.place]]


def whole_element(page: Page, begin: int, end: int, kept: list[int]) -> tuple[int, int]:
    """The run, or all of the smallest element around it, if the run is most of that: ends that were too short or too linked to score belong to it.

    Of elements other than ``article``, linked blocks at the ends stay outside. ``kept``: blocks that are not left out.
    """
    words, total = Counter(), Counter()
    for i in kept:
        total[page.events[i].place] += page.events[i].words
        words[page.events[i].place] += page.events[i].words if begin <= i < end else 0
    words, total = page.sums(words), page.sums(total)
    run = words[0]
    around = [j for j, n in enumerate(words) if n and n >= 0.9 * run and n >= (0.5 if page.elements[j].tag == "article" else 0.7) * total[j]]
    around = [j for j in around if j and page.elements[j].tag not in ("html", "body", "form", "table", "tbody", "tr")]
    if not around:
        return begin, end
    j = next((j for j in around if page.elements[j].tag == "article"), min(around, key=lambda j: (total[j], -j)))
    members = [i for i in kept if page.holds(j, page.events[i].place)]
    if page.elements[j].tag != "article":
        plain = [i for i in members if begin <= i < end or 2 * page.events[i].linked <= page.events[i].words]
        members = [i for i in members if plain[0] <= i <= plain[-1]]
    return min(begin, members[0]), max(end, members[-1] + 1)


def scores_of(page: Page, model: Weights, dropped: list[Block]) -> list[float]:
    """Score of each event. Of boilerplate blocks in a row the first costs most: a list of links is one obstacle, not many."""
    out, before, gone = [], False, {id(b) for b in dropped}
    for event in page.events:
        if isinstance(event, str):
            out.append(model.tag.get(event, model.other_tag))
            continue
        score = -float(event.words) if id(event) in gone else model.block(page, event)
        out.append(max(score, -1.0 if before else -BARRIER))
        before = score < 0
    return out


def main_text(html: str, model: Weights | None = None) -> str:
    model = model or weights()
    page = read_page(html)
    dropped = inside(page, left_out(page, model))
    gone = {id(b) for b in dropped}
    scores = scores_of(page, model, dropped)
    kept = [i for i, e in enumerate(page.events) if isinstance(e, Block) and id(e) not in gone]
    begin, end = best_run(scores)
    if begin == end:  # nothing reads like an article: the best single block
        plain = [i for i in kept if page.events[i].linked < page.events[i].words]
        if not plain:
            return ""
        begin = max(plain, key=lambda i: (page.events[i].words - page.events[i].linked, -i))
        end = begin + 1
    begin, end = whole_element(page, begin, end, kept)
    return " ".join(page.events[i].text for i in kept if begin <= i < end)


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``.

    ``pages`` needs page_id, url and ``html``; other columns are ignored, whatever their names. Null and empty pages, and pages without
    any word outside links, forms and boilerplate, give an empty text; where no region scores above zero, the longest block is the text. Of equal regions the first is
    taken. An unclosed comment ends at the next ``>``. Repeated rows give a row each. An empty table gives no rows.
    """
    rows = exactly(pages, "page_id", "url", html)
    kinds = [f.dataType.simpleString() for f in rows.schema.fields[:2]]

    model = weights()  # a few hundred numbers, fitted once and sent along

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in batches_of([whole], 4_000_000)):
            texts = [main_text(h.as_py(), model) if h.is_valid else "" for h in batch.column("_html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = rows.select("page_id", "url", rows[html].cast("string").alias("_html"))
    return rows.mapInArrow(extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
