"""Patterns, character sets and word lists used by the operators."""

from __future__ import annotations

# --- fixed values: character classes (Java regex, for use inside [...]) ---------
# Unicode white space plus the four separators that Python also treats as space.
WS = r"\p{IsWhite_Space}\x1c-\x1f"
# A Python "word" character: letter, number or underscore (no combining marks).
WORD_CHAR = r"\p{L}\p{N}_"

# --- fixed values: cleaning ------------------------------------------------------
TAG = r"<[^>]+>"
LINK = rf"http[^{WS}]+"
KEEP_ALPHABET = "a-zA-Zа-яА-Я0-9"
KEEP_PUNCT = ".,!?"

# --- fixed values: tokens ---------------------------------------------------------
WORD_ALPHABET = "A-Za-zА-Яа-яЁё"
NAIVE_STRIP = "«»()[]{}.,:;!?\"'“”—–…"
# Extra letters of the Western European languages, for the alphabet parameters.
LATIN_EXTRA = "À-ÖØ-öø-ÿŒœ"

# --- fixed values: punctuation ----------------------------------------------------
DASHES = "—–"
QUOTES = "“”«»"
PUNCT = ",.!?;:"

# --- fixed values: placeholders, applied in this order ------------------------------
NUM_TOKEN, URL_TOKEN, EMAIL_TOKEN = "<NUM>", "<URL>", "<EMAIL>"

# --- fixed values: abbreviations, applied in this order ------------------------------
ABBREVIATIONS_RU = [
    ("т.е.", "то есть"),
    ("т.к.", "так как"),
    ("г.", "год"),
    ("др.", "другие"),
    ("т.д.", "так далее"),
    ("т.п.", "тому подобное"),
    ("т.н.", "так называемый"),
    ("т.ч.", "том числе"),
    ("рф", "российская федерация"),
    ("сша", "соединенные штаты америки"),
    ("ес", "европейский союз"),
]
ABBREVIATIONS = {
    "ru": ABBREVIATIONS_RU,
    "en": [
        ("e.g.", "for example"), ("i.e.", "that is"), ("etc.", "and so on"),
        ("ed.", "edition"), ("st.", "street"), ("usa", "united states"),
    ],
    "de": [
        ("z.b.", "zum beispiel"), ("d.h.", "das heisst"), ("usw.", "und so weiter"),
        ("nr.", "nummer"), ("eu", "europaeische union"),
    ],
    "fr": [
        ("p.ex.", "par exemple"), ("c.-à-d.", "c'est-à-dire"), ("etc.", "et cetera"),
        ("av.", "avenue"), ("ue", "union européenne"),
    ],
    "es": [
        ("p.ej.", "por ejemplo"), ("etc.", "etcétera"), ("sr.", "señor"),
        ("ee.uu.", "estados unidos"), ("ue", "unión europea"),
    ],
}

# --- fixed values: stop words ---------------------------------------------------------
STOPWORDS = {
    "ru": """и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по
        только ее мне было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если уже
        или ни быть был него до вас нибудь опять уж вам ведь там потом себя ничего ей может они
        тут где есть надо ней для мы тебя их чем была сам чтоб без будто чего раз тоже себе под
        будет ж тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем
        чтобы нее сейчас были куда зачем всех никогда можно при наконец два об другой хоть после
        над больше тот через эти нас про всего них какая много разве три эту моя впрочем хорошо
        свою этой перед иногда лучше чуть том нельзя такой им более всегда конечно всю
        между""".split(),
    "en": """a an and are as at be but by for from had has have he her his i if in into is it its
        me my no not of on or our she so that the their them then there these they this to was
        we were which who will with you your""".split(),
    "de": """aber als am an auch auf aus bei bin bis da das dem den der des die du ein eine einem
        einen einer er es für hat ich ihr im in ist mit nach nicht noch nur oder sie sind so über
        um und von war was wenn wie wir zu zum zur""".split(),
    "fr": """à au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur lui
        mais me mon ne nous on ou par pas pour qu que qui sa se ses son sur ta te tu un une vous
        y""".split(),
    "es": """a al ante como con de del desde el ella en entre es ese esta este la las le lo los
        más me mi muy no nos o para pero por que se si sin sobre su sus también te tu un una y
        ya""".split(),
}

# --- fixed values: pages ----------------------------------------------------------------
BOILERPLATE_TAGS = ["script", "style", "aside", "header", "footer", "nav"]
PARAGRAPH_MIN_WORDS = 3
ARTICLE_MIN_WORDS = 100
CORPUS_WORD_BUDGET = 55_000
MEDIA_EXTENSIONS = ["jpg", "jpeg", "png", "gif", "pdf", "zip"]
ISO_DATE = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
# First three letters of English and Russian month names.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "янв": 1, "фев": 2, "мар": 3, "апр": 4, "май": 5, "мая": 5, "июн": 6,
    "июл": 7, "авг": 8, "сен": 9, "окт": 10, "ноя": 11, "дек": 12,
}
ZONES = {
    "Z": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "UT": "+00:00",
    "MSK": "+03:00", "МСК": "+03:00", "CET": "+01:00", "CEST": "+02:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

# --- fixed values: subword models ----------------------------------------------------------
UNK = "[UNK]"
CONTINUATION = "##"
VOCAB_SIZES = [8_000, 16_000, 32_000]
MIN_FREQUENCY = 3
WORDPIECE_MAX_CHARS = 100
TRAIN_FRACTION = 0.8
