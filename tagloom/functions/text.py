"""Columns over strings: code point offsets, word classes, language codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as a Java class.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
PUNCTUATION, NUMBER = r"^\p{P}+$", r"^\p{P}*\p{N}[\p{N}\p{P}]*$"
#: Separators of the plain word splitter.
WORD_BREAK = r"[ \t\n\r\f]+"
# Two-letter codes of languages and their three-letter forms.
LANGUAGE_CODES = {
    "aa": "aar", "ab": "abk", "ae": "ave", "af": "afr", "ak": "aka", "am": "amh", "an": "arg", "ar": "ara", "as": "asm", "av": "ava", "ay": "aym", "az": "aze",
    "ba": "bak", "be": "bel", "bg": "bul", "bi": "bis", "bm": "bam", "bn": "ben", "bo": "bod", "br": "bre", "bs": "bos", "ca": "cat", "ce": "che", "ch": "cha",
    "co": "cos", "cr": "cre", "cs": "ces", "cu": "chu", "cv": "chv", "cy": "cym", "da": "dan", "de": "deu", "dv": "div", "dz": "dzo", "ee": "ewe", "el": "ell",
    "en": "eng", "eo": "epo", "es": "spa", "et": "est", "eu": "eus", "fa": "fas", "ff": "ful", "fi": "fin", "fj": "fij", "fo": "fao", "fr": "fra", "fy": "fry",
    "ga": "gle", "gd": "gla", "gl": "glg", "gn": "grn", "gu": "guj", "gv": "glv", "ha": "hau", "he": "heb", "hi": "hin", "ho": "hmo", "hr": "hrv", "ht": "hat",
    "hu": "hun", "hy": "hye", "hz": "her", "ia": "ina", "id": "ind", "ie": "ile", "ig": "ibo", "ii": "iii", "ik": "ipk", "io": "ido", "is": "isl", "it": "ita",
    "iu": "iku", "ja": "jpn", "jv": "jav", "ka": "kat", "kg": "kon", "ki": "kik", "kj": "kua", "kk": "kaz", "kl": "kal", "km": "khm", "kn": "kan", "ko": "kor",
    "kr": "kau", "ks": "kas", "ku": "kur", "kv": "kom", "kw": "cor", "ky": "kir", "la": "lat", "lb": "ltz", "lg": "lug", "li": "lim", "ln": "lin", "lo": "lao",
    "lt": "lit", "lu": "lub", "lv": "lav", "mg": "mlg", "mh": "mah", "mi": "mri", "mk": "mkd", "ml": "mal", "mn": "mon", "mr": "mar", "ms": "msa", "mt": "mlt",
    "my": "mya", "na": "nau", "nb": "nob", "nd": "nde", "ne": "nep", "ng": "ndo", "nl": "nld", "nn": "nno", "no": "nor", "nr": "nbl", "nv": "nav", "ny": "nya",
    "oc": "oci", "oj": "oji", "om": "orm", "or": "ori", "os": "oss", "pa": "pan", "pi": "pli", "pl": "pol", "ps": "pus", "pt": "por", "qu": "que", "rm": "roh",
    "rn": "run", "ro": "ron", "ru": "rus", "rw": "kin", "sa": "san", "sc": "srd", "sd": "snd", "se": "sme", "sg": "sag", "si": "sin", "sk": "slk", "sl": "slv",
    "sm": "smo", "sn": "sna", "so": "som", "sq": "sqi", "sr": "srp", "ss": "ssw", "st": "sot", "su": "sun", "sv": "swe", "sw": "swa", "ta": "tam", "te": "tel",
    "tg": "tgk", "th": "tha", "ti": "tir", "tk": "tuk", "tl": "tgl", "tn": "tsn", "to": "ton", "tr": "tur", "ts": "tso", "tt": "tat", "tw": "twi", "ty": "tah",
    "ug": "uig", "uk": "ukr", "ur": "urd", "uz": "uzb", "ve": "ven", "vi": "vie", "vo": "vol", "wa": "wln", "wo": "wol", "xh": "xho", "yi": "yid", "yo": "yor",
    "za": "zha", "zh": "zho", "zu": "zul",
}
# Usual scripts other than Latin, and the three-letter codes of languages written in them.
_WRITTEN_IN = {
    "Arab": "ara arb ary arz ckb fas kas pbt pes pnb prs pus skr snd uig urd", "Armn": "hye hyw", "Beng": "asm ben", "Cans": "cre iku oji",
    "Cyrl": "abk ava bak bel bul che chu chv kaz kir kom mhr mkd mon myv oss rue rus sah srp tat tgk tyv udm ukr", "Deva": "awa bho hin mai mar nep new pli san",
    "Ethi": "amh tir", "Geor": "kat xmf", "Grek": "ell grc pnt", "Gujr": "guj", "Guru": "pan", "Hang": "kor", "Hans": "gan wuu", "Hani": "cmn", "Hant": "yue",
    "Hebr": "heb yid", "Jpan": "jpn", "Khmr": "khm", "Knda": "kan", "Laoo": "lao", "Mlym": "mal", "Mymr": "mya", "Orya": "ori", "Sinh": "sin", "Syrc": "arc syc",
    "Taml": "tam", "Telu": "tel", "Thaa": "div", "Thai": "tha", "Tibt": "bod dzo", "Yiii": "iii",
}
#: Script by three-letter code. A language with a two-letter code, and some others, that isn't listed above is written in Latin.
SCRIPTS = {code: script for script, codes in _WRITTEN_IN.items() for code in codes.split()}
LATIN = frozenset(LANGUAGE_CODES.values()) - SCRIPTS.keys() | {"als", "ast", "bar", "ceb", "fil", "hsb", "ilo", "lij", "lmo", "luo", "nds", "pcm", "scn", "vec", "war"}
#: Languages whose tokenizer is that of another, and languages written without blanks.
TOKENIZER_OF = {"zho": "cmn", "nan": "cmn"}
UNSPACED = ("cmn", "jpn", "zho", "yue", "zh-classical")
IGNORED_LANGUAGES = ("MULTI",)


def _mapped(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def strip(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return text.rlike(f"^{SPACE}*$")


def piece(text: Column, start: Column, stop: Column) -> Column:
    """text[start:stop] in code points, for 0 <= start."""
    return F.substring(text, start.cast("int") + 1, F.greatest(stop - start, F.lit(0)).cast("int"))


def find(text: Column, token: Column, start: Column) -> Column:
    """The first place of token at or after start, or -1. An empty token is found at start."""
    return F.when(F.length(token) == 0, start.cast("long")).otherwise(F.call_function("locate", token, text, (start + 1).cast("int")).cast("long") - 1)


def char_of_byte(text: Column, byte: Column) -> Column:
    """The number of characters in the first `byte` bytes of the text in UTF-8."""
    return F.length(F.decode(F.substring(F.encode(text, "UTF-8"), 1, byte.cast("int")), "UTF-8")).cast("long")


def words(text: Column) -> Column:
    """Runs between blanks, tabs, line ends and form feeds."""
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def is_punctuation(token: Column) -> Column:
    return token.rlike(PUNCTUATION)


def is_number(token: Column) -> Column:
    return token.rlike(NUMBER) & ~is_punctuation(token)


def iso_language(code: Column) -> Column:
    """Three-letter code, script kept; unknown codes stay as they are."""
    head, tail = F.substring_index(code, "-", 1), F.regexp_extract(code, "-.*$", 0)
    return F.concat(F.coalesce(_mapped(head, LANGUAGE_CODES), head), tail)


def tokenizer_language(code: Column) -> Column:
    """The three-letter code with its usual script, as names of word tokenizers have it; a code of an unknown language stays."""
    base = F.coalesce(_mapped(code, TOKENIZER_OF), code)
    script = F.coalesce(_mapped(base, SCRIPTS), F.when(base.isin(*LATIN), "Latn"))
    return F.concat_ws("_", base, script)


def primary_language(code: Column) -> Column:
    return F.substring_index(code, "-", 1)


def config_name(dataset: Column, subsets: Column) -> Column:
    """dataset--a--b from a name and an array of subsets."""
    return F.concat_ws("--", dataset, subsets)


def size_category(n: Column) -> Column:
    """Names of ranges of row counts; an exact bound belongs to the range below it."""
    names = ["n<1K", "1K<n<10K", "10K<n<100K", "100K<n<1M", "1M<n<10M", "10M<n<100M", "100M<n<1B", "1B<n<10B", "10B<n<100B", "100B<n<1T"]
    out = F.when(n <= 1000, names[0])
    for power, name in enumerate(names[1:], 4):
        out = out.when(n <= 10**power, name)
    return out.otherwise("n>1T")
