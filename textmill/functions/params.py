"""Per-language parameters of the quality filters, as data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..data import word_lists

_FIELDS = ("long_word", "min_words", "max_words", "char_n", "char_max", "word_n", "word_max", "special_max", "stop_min", "flagged_max", "lang_min", "perplexity_max")
_ROWS = """
default 0 10 100000 10 .2 5 .3 .4 .1 .1 .7 10000
ar 25 20 100000 10 .2 5 .34 .3 .07 .03 .81 2300
bn 20 33 100000 10 .13 5 .21 .45 .002 .001 .95 2000
ca 20 15 100000 10 .2 5 .4 .25 .25 .1 .8 2500
en 25 20 100000 10 .106 5 .19 .4 .3 .01 .8 1500
es 25 16 100000 10 .14 5 .25 .34 .4 .01 .8 1300
eu 28 8 100000 10 .2 5 .4 .31 .05 .1 .7 3000
fr 45 13 100000 10 .14 5 .13 .34 .27 .008 .8 1770
hi 25 38 100000 10 .18 5 .47 .45 .01 .005 .9 1517
id 30 15 100000 10 .15 5 .2 .34 .15 .01 .7 5000
pt 19 19 100000 10 .25 5 .98 .35 .2 .007 .6 3038
ur 20 25 100000 10 .19 7 .5 .25 .01 .025 .9 1495
vi 25 30 100000 10 .15 5 .2 .34 .08 .005 .9 1600
zh 0 1 1000000 3 .2 5 .96 .3 .1691 .001 .85 2095
"""
#: language -> parameters; a long_word of 0 means no limit
PARAMETERS: dict[str, dict[str, float]] = {r.split()[0]: dict(zip(_FIELDS, map(float, r.split()[1:]))) for r in _ROWS.strip().splitlines()}
#: Languages whose stop and flagged words also look at joined pairs of words, and the joint.
PAIRS = {"vi": " ", "zh": ""}

STOPWORDS: dict[str, list[str]] = word_lists("stopwords.txt")
FLAGGED: dict[str, list[str]] = word_lists("flagged.txt")
#: Languages whose documents keep words that hold fragments of links; those without a long_word keep long words anyway.
KEEP_FRAGMENTS = ("default", "zh")
_NAMES = """
ar=Arabic bn=Bengali ca=Catalan code=Code de=German en=English es=Spanish eu=Basque fr=French gu=Gujarati hi=Hindi id=Indonesian kn=Kannada ml=Malayalam mr=Marathi ne=Nepali
or=Odia pa=Punjabi pt=Portuguese ta=Tamil te=Telugu ur=Urdu vi=Vietnamese zh=Chinese zhs=Simplified_Chinese zht=Traditional_Chinese as=Assamese ak=Akan bm=Bambara fon=Fon ig=Igbo
ki=Kikuyu lg=Luganda ln=Lingala nso=Northern_Sotho ny=Chichewa rn=Kirundi rw=Kinyarwanda sn=Shona st=Sesotho sw=Swahili tn=Setswana ts=Xitsonga tum=Tumbuka tw=Twi wo=Wolof xh=Xhosa yo=Yoruba zu=Zulu
"""
LANGUAGE_NAMES = {k: v.replace("_", " ") for k, v in (x.split("=") for x in _NAMES.split())}


def parameter(name: str, lang: str | Column = "lang") -> Column:
    """The parameter of each row's language, or the default one."""
    lang = F.col(lang) if isinstance(lang, str) else lang
    table = F.create_map(*[F.lit(x) for k, v in PARAMETERS.items() for x in (k, v[name])])
    return F.coalesce(table[lang], F.lit(PARAMETERS["default"][name]))


def word_list(lists: dict[str, list[str]], lang: str | Column = "lang") -> Column:
    """The list of each row's language; null where there is none, and with it the check."""
    lang = F.col(lang) if isinstance(lang, str) else lang
    return F.create_map(*[x for k, v in lists.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])[lang]


def sql_parameter(name: str, lang: str = "lang") -> str:
    return "CASE " + lang + " " + " ".join(f"WHEN '{k}' THEN {v[name]}" for k, v in PARAMETERS.items() if k != "default") + f" ELSE {PARAMETERS['default'][name]} END"


def sql_list(lists: dict[str, list[str]], lang: str = "lang") -> str:
    return f"CASE {lang} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in lists.items()) + " END"
