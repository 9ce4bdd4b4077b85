"""Fixed values. Results depend on each of them being exactly as written."""

# --- letters and digits ---------------------------------------------------------------
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ASCII_DIGITS = "0123456789"
ARABIC_LETTERS = "كىيئإأةؤ"
PERSIAN_LETTERS = "کیییااهو"
DIACRITICS = "".join(chr(c) for c in range(0x064B, 0x0653))
ZWNJ = "‌"

# --- character classes, valid in Java regular expressions and in RE2 -----------------
SPACE_CHARS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same white space as characters, and as a class without U+0020.
SPACES = "".join(
    map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
SPACE_CHARS_BUT_BLANK = SPACE_CHARS.replace(r"\x{1c}-\x{20}", r"\x{1c}-\x{1f}")
WORD_CHARS = r"\p{L}\p{N}_"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PERSIAN_PUNCTUATION = "،؟؛«»"
PADDED_PUNCTUATION = r"""-*.,/"!?:;،؟؛«»()\[\]{}'…"""
PERSIAN_TOKEN = r"[\x{600}-\x{6FF}]+"
LETTER_TOKEN = r"[\p{L}]+"

# --- words ------------------------------------------------------------------------------
RATING_WORDS = {"1": "خیلی بد", "2": "بد", "3": "متوسط", "4": "خوب", "5": "عالی"}

LIGHT_STOPWORDS = (
    "و یا اما که این آن اینها آنها با برای از در بر به تا را رو روی بین جز اگر اگرچه چون پس هم همه هر "
    "هیچ چند چرا چگونه کجا چه کی من تو او ما شما ایشان خود خودم خودش خودمان خودتان خودشان یک یکی دو سه "
    "چند بعضی دیگر دیگه همین همان اینجا آنجا الان اکنون امروز دیروز فردا همیشه گاهی معمولا تقریبا واقعا "
    "خیلی بسیار فقط تقریبا"
).split()

# --- sentiment --------------------------------------------------------------------------
NEUTRAL_PHRASES = [
    "بد نیست",
    "بد‌نیست",
    "بد نبود",
    "بدک نیست",
    "بدی نیست",
    "نظری ندارم",
    "نظر خاصی ندارم",
    "ندارم",
    "نه خوب نه بعد",
    "معمولی",
]
# The sentiment rule knows one phrase more than the classification rule.
NEUTRAL_PHRASES_SENTIMENT = NEUTRAL_PHRASES + ["بابت تاخیر عذر خواهی"]
POSITIVE_PHRASES = [
    "حرف نداره",
    "عالیه",
    "خیلی خوبه",
    "واقعا خوبه",
    "دمتون گرم",
    "دستتون درد نکنه",
    "خسته نباشید",
    "سپاس فراوان",
    "کار راه بنداز",
    "از این بهتر نیست",
    "خیلی خفنه",
    "عالی لامصب",
    "خیلی عال",
    "بسیارعلی",
    "عالی،بود",
    "خیلی الی",
    "خیلی خوی",
    "بسیار الی",
    "خیلی خفنی",
    "بسیار هالی",
    "بانک ملت تکه",
]
UNCLEAR_LABELS = ["no sentiment expressed", "mixed", "neutral"]
NO_SENTIMENT = "no sentiment expressed"
SCORES_FIVE_POINT = {
    "very negative": 1,
    "negative": 2,
    "neutral": 3,
    "mixed": 3,
    "positive": 4,
    "very positive": 5,
    "no sentiment expressed": 3,
}
SCORES_SIGNED = {
    "very negative": -2,
    "negative": -1,
    "neutral": 0,
    "mixed": 0,
    "positive": 1,
    "very positive": 2,
    "no sentiment expressed": 0,
}
MISSED_LABEL, MISSED_SCORE = "Missed Value", 11
EMPTY_LABEL, EMPTY_SCORE = "no comments", 0
SENTIMENT_LABELS_OF_GROUP = {
    "positive": ["very positive", "positive"],
    "negative": ["very negative", "negative"],
    "neutral": ["no sentiment expressed", "neutral", "mixed"],
}
SCORES_OF_GROUP = {"negative": [1, 2], "neutral": [3], "positive": [4, 5], "all": [1, 2, 3, 4, 5]}

# --- classification ---------------------------------------------------------------------
FEATURE_OF_TITLE = {
    "دریافت تسهیلات": "loan",
    "انتقال وجه": "transfer",
    "کارت‌ها": "card",
    "پرداخت قبض": "bill",
    "خرید شارژ": "top-up",
    "دستیار هوشمند": "ai",
    "مدیریت حساب‌ها": "account",
    "سایر": "other",
    "پروفایل": "profile",
    "خرید اینترنت": "internet package",
    "کلیت اپلیکیشن": "in general",
}
TYPES = ["issue", "suggestion", "question", "praise", "criticism", "other"]
CATEGORIES = ["auth", "login", "ui", "performance", "support", "security", "notification", "other"]
CATEGORY_ALIASES = {"authentication": "auth", "customer support": "support"}
FEATURES = [
    "transfer", "card", "bill", "loan", "in general", "ai assistant", "account", "top-up",
    "internet package", "profile", "other",
]
FEATURE_ALIASES = {"ai": "ai assistant", "ai_assistant": "ai assistant"}
STRICT_TYPES = ["issue", "suggestion", "question", "praise", "other"]
STRICT_CATEGORIES = [
    "transfer", "auth", "card", "bill", "loan", "login", "ui", "performance", "AI assistant", "other",
]
LEVELS = ["high", "medium", "low"]
GENERAL_KEYWORD = "عمومی"
SHORT_COMMENT_MODEL = "rule_based_short_comment"
NOTHING_LINE = "- (هیچ موردی)"

# Wording of a suggestion; each is matched as a whole word or phrase.
SUGGESTION_PATTERNS = [
    r"پیشنهاد",
    r"بهتر\s*است",
    r"کاش",
    r"لطفا",
    r"امکان",
    r"اضافه\s*شود",
    r"اضافه\s*کنید",
    r"قرار\s*بدید",
    r"در\s*نظر\s*بگیرید",
    r"نیاز\s*است",
    r"باید",
    r"میخوام",
    "می‌خوام",
    r"میخواهم",
    "می‌خواهم",
    r"فعال\s*شود",
    r"فراهم\s*شود",
    r"امکانش",
    r"قابلیت",
]

# --- apps -------------------------------------------------------------------------------
ACCEPTED_APP_CATEGORIES = ["امور مالی", "شبکه‌های اجتماعی"]
