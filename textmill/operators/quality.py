"""Per-document quality metrics, the filters built of them, and document repair."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import params as P
from ..functions import text as T

BAD_PARTS = ("http", "www", ".com", "href", "//")
MAPS_CHAR, MAPS_WORD = range(2, 16), range(3, 11)


#: Texts are handled so many characters at a time, so that what is made of them stays in a core's cache.
CHUNK = 1 << 16
#: Rows of an Arrow batch that are Python strings at a time.
ROWS = 512


def chunks(sizes: list[int], most: int = CHUNK) -> Iterator[slice]:
    """Runs of neighbours with about so much in all; what is larger alone is one of its own."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * np.uint64(0x9E3779B97F4A7C15)
    out += b
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _fold(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number for each run of n codes, made of those of runs of 1, 2, 4 and so on."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    have, size, out, done = codes.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if n & size:
            out = have if out is None else _joined(out[: len(codes) - done - size + 1], have[done:])
            done += size
        if done == n:
            return out
        have = _joined(have[:-size], have[size:])
        size *= 2


def _repeated(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each n-gram that its text has more than once occurs there, and the text's place; hashes are of all runs of codes, a text has ``counts`` of them from ``starts``."""
    ends = np.cumsum(counts)
    own = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    if not len(own):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    for s, e, n in zip(starts.tolist(), ends.tolist(), counts.tolist()):
        if n:
            part = own[e - n : e]
            part[:] = hashes[s : s + n]
            part.sort()
    new = np.ones(len(own), bool)
    np.not_equal(own[1:], own[:-1], out=new[1:])
    new[(ends - counts)[counts > 0]] = True
    at = np.flatnonzero(new)
    freq = np.diff(at, append=len(own))
    many = freq > 1
    return freq[many], np.searchsorted(ends, at[many], "right")


def _shares(part: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.divide(part, counts, out=np.zeros(len(counts)), where=counts > 0)


def _char_shares(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    freq, owner = _repeated(hashes, starts, counts)
    groups = np.bincount(owner, minlength=len(counts))
    distinct = groups + counts - np.bincount(owner, freq, len(counts)).astype(np.int64)
    k = np.minimum(np.sqrt(distinct).astype(np.int64), groups)
    # Owners are in order already: sorted by owner and falling number, they stay where they are.
    freq = (1 << 32) - (np.sort((owner << 32) + (1 << 32) - freq) - (owner << 32))
    rank = np.arange(len(owner)) - (np.cumsum(groups) - groups)[owner]
    return _shares(np.bincount(owner, np.where(rank < k[owner], freq, 0), len(counts)), counts)


def _word_shares(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    freq, owner = _repeated(hashes, starts, counts)
    return _shares(np.bincount(owner, freq, len(counts)), counts)


def char_codes(texts: list[str]) -> np.ndarray:
    """The code points of all texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def word_codes(lists: list[list[str]]) -> np.ndarray:
    """A number for each word of all lists, equal for equal words."""
    number = defaultdict(itertools.count().__next__)
    return np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(lists)), np.int64)


def _by_n(shares: Callable, codes: np.ndarray, sizes: list[int], ns: list[int]) -> np.ndarray:
    """The share of each text, over runs of its own n."""
    size, n_of = np.asarray(sizes, np.int64), np.asarray(ns, np.int64)
    starts, out = np.cumsum(size) - size, np.zeros(len(size))
    for n in sorted(set(ns)):
        of = np.flatnonzero(n_of == n)
        out[of] = shares(_fold(codes, n), starts[of], np.maximum(size[of] - n + 1, 0))
    return out


def char_repetition(text: str, n: int) -> float:
    """Share of the commonest n-grams of characters: as many as the root of the distinct ones, without those that occur once."""
    return float(_by_n(_char_shares, char_codes([text]), [len(text)], [n])[0])


def word_repetition(words: list[str], n: int) -> float:
    """Share of the runs of n words that occur more than once."""
    return float(_by_n(_word_shares, word_codes([words]), [len(words)], [n])[0])


def _all_n(shares: Callable, codes: np.ndarray, sizes: list[int], ns: range) -> np.ndarray:
    """A row for each text, a column for each n; the runs of n + 1 are made of those of n."""
    size, codes = np.asarray(sizes, np.int64), codes.astype(np.uint64) + np.uint64(1)
    starts, columns, h = np.cumsum(size) - size, [], codes
    for n in range(1, ns.stop):
        if n > 1:
            h = _joined(h[: max(len(codes) - n + 1, 0)], codes[n - 1 :])
        if n in ns:
            columns.append(shares(h, starts, np.maximum(size - n + 1, 0)))
    return np.stack(columns, 1)


_SPECIAL = np.zeros(0x110000, bool)
_SPECIAL[[ord(c) for c in T.SPECIAL]] = True


class _Stripped(dict):
    """Words without the signs at their ends, each made once."""

    def __missing__(self, word: str) -> str:
        self[word] = core = word.strip(T.SPECIAL)
        return core


_stripped, _MOST_STRIPPED = _Stripped(), 1 << 16


def words_of(text: str) -> list[str]:
    """What ``functions.text.words`` gives for a text."""
    if len(_stripped) > _MOST_STRIPPED:
        _stripped.clear()
    return [w for w in map(_stripped.__getitem__, text.lower().replace("\n", " ").replace("\t", " ").split(" ")) if w]


def member_share(words: list[str], members: frozenset | None, pair: str | None) -> float | None:
    """Share of words (and, with a joint, of pairs of neighbours) that are members, at most 1; None without a list."""
    if members is None:
        return None
    if not words:
        return 0.0
    hits = sum(map(members.__contains__, words))
    if pair is not None:
        hits += sum(f"{a}{pair}{b}" in members for a, b in zip(words, words[1:]))
    return min(hits / len(words), 1.0)


METRICS = ("n_words", "special_ratio", "stopword_ratio", "flagged_ratio", "char_repetition", "word_repetition")
_KIND = "n_words int, special_ratio double, stopword_ratio double, flagged_ratio double, char_repetition double, word_repetition double"


def metrics_of(texts: list[str], langs: list[str | None], split: Callable[[str], list[str]], lists: list[dict[str, frozenset]], repetition: bool) -> Iterator[tuple]:
    """The metrics of some texts in the order of METRICS."""
    codes, sizes, words = char_codes(texts), [len(t) for t in texts], [split(t) for t in texts]
    ps = [P.PARAMETERS.get(k) or P.PARAMETERS["default"] for k in langs]
    marks = np.cumsum(np.concatenate([[0], _SPECIAL[codes]]))[np.cumsum([0, *sizes])]
    special = _shares(np.diff(marks), np.asarray(sizes, np.int64)).tolist()
    chars = reps = [None] * len(texts)
    if repetition:
        chars = _by_n(_char_shares, codes, sizes, [int(p["char_n"]) for p in ps]).tolist()
        reps = _by_n(_word_shares, word_codes(words), [len(w) for w in words], [int(p["word_n"]) for p in ps]).tolist()
    for w, k, *rest in zip(words, langs, special, chars, reps):
        shares = [member_share(w, x.get(k), P.PAIRS.get(k)) for x in lists]
        yield len(w), rest[0], *shares, *rest[1:]


def metrics_udf(repetition: bool = True, make_words: Callable[[], Callable[[str], list[str]]] | None = None, stopwords: dict | None = None, flagged: dict | None = None):
    """All metrics of a text in one pass: its words are made once, and lists are sets.

    make_words makes, once per worker, another way to get a text's words, such as
    a model's pieces for languages that don't write blanks.  A null text has null
    metrics.  The function counts as not deterministic, so that the planner
    neither repeats it nor moves it.
    """
    lists = [{k: frozenset(v) for k, v in (x or default).items()} for x, default in ((stopwords, P.STOPWORDS), (flagged, P.FLAGGED))]

    @F.pandas_udf(_KIND)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        split = make_words() if make_words else words_of
        for texts, langs in batches:
            found = [(None,) * len(METRICS)] * len(texts)
            some = [i for i, t in enumerate(texts) if t is not None]
            texts, langs = [texts.iat[i] for i in some], [langs.iat[i] for i in some]
            for part in chunks([len(t) for t in texts]):
                for i, row in zip(some[part], metrics_of(texts[part], langs[part], split, lists, repetition)):
                    found[i] = row
            yield pd.DataFrame(found, columns=METRICS).astype({"n_words": "Int32", **{m: "float64" for m in METRICS[1:]}})

    return run.asNondeterministic()


def with_metrics(df: DataFrame, text: str = "text", lang: str = "lang", repetition: bool = True, **options) -> DataFrame:
    """df with its metrics, which one Arrow function makes of text and language alone."""
    found = df.withColumn("__m", metrics_udf(repetition, **options)(F.col(text), F.col(lang)))
    return found.withColumns({m: F.col(f"__m.{m}") for m in METRICS[: None if repetition else 4]}).drop("__m")


def checks(lang: str = "lang", repetition: bool = True) -> dict[str, Column]:
    """Each filter as a condition that kept documents meet; bounds are part of what is kept."""
    p = lambda name: P.parameter(name, lang)
    found = {"words_ok": F.col("n_words").between(p("min_words"), p("max_words"))}
    if repetition:
        found |= {"char_repetition_ok": F.col("char_repetition") <= p("char_max"), "word_repetition_ok": F.col("word_repetition") <= p("word_max")}
    return found | {
        "special_ok": F.col("special_ratio") <= p("special_max"),
        "stopwords_ok": F.coalesce(F.col("stopword_ratio") >= p("stop_min"), F.lit(True)),
        "flagged_ok": F.coalesce(F.col("flagged_ratio") <= p("flagged_max"), F.lit(True)),
    }


def model_checks(predicted: Column, score: Column, perplexity: Column | None = None, lang: str = "lang") -> dict[str, Column]:
    """The filters that need models: the predicted language is the row's and sure enough, the perplexity not too high.  Null scores pass."""
    found = {"language_ok": F.coalesce((predicted == F.col(lang)) & (score >= P.parameter("lang_min", lang)), F.lit(True))}
    if perplexity is not None:
        found["perplexity_ok"] = F.coalesce(perplexity <= P.parameter("perplexity_max", lang), F.lit(True))
    return found


def filter_documents(df: DataFrame, lang: str = "lang", more: dict[str, Column] | None = None, **options) -> DataFrame:
    """Documents that pass all checks, and those of ``more`` (as ``model_checks`` gives them)."""
    ok = F.lit(True)
    for c in (checks(lang) | (more or {})).values():
        ok = ok & c
    return with_metrics(df, lang=lang, **options).where(ok).select(*df.columns)


def discarded_share(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Percentage that each filter alone would remove."""
    return df.agg(*[F.round(F.avg((~c).cast("double")) * 100, 6).alias(n) for n, c in conditions.items()])


def should_keep(value: Column, threshold: float, kind: str) -> Column:
    """kind 'max': up to the threshold; 'min': from it."""
    if kind not in ("min", "max"):
        raise ValueError("kind is min or max")
    return value <= threshold if kind == "max" else value >= threshold


_ENDS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = {ord(c): " " for c in T.WIDE_SPACES}


def repaired(text: str, limit: int, bad: re.Pattern | None) -> str:
    """A text without words that hold what ``bad`` finds and without words over the limit (0: none), its line and tab structure kept."""
    def good(w: str) -> bool:
        if not limit or len(w) <= limit:
            return bad is None or not bad.search(w) or not bad.search(w.strip(T.SPECIAL))
        core = w.strip(T.SPECIAL)
        return 1 <= len(core) <= limit and (bad is None or not bad.search(core))

    def cell(c: str) -> str:
        return " ".join([w for w in c.split(" ") if w and good(w)])

    def line(x: str) -> str:
        return "\t".join([y for y in map(cell, x.split("\t")) if y])

    return "\n".join([y for y in map(line, text.strip(_ENDS).translate(_SPACES).split("\n")) if y])


def repair(c: Column, lang: str | Column = "lang", bad_parts=BAD_PARTS, marks: bool = False) -> Column:
    """A document without words that hold link fragments and without over-long words, as its language wants it.

    Languages of KEEP_FRAGMENTS, and unknown ones, keep words with fragments.
    """
    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        bad = re.compile("|".join(map(re.escape, bad_parts)))
        for texts, langs in batches:
            out = []
            for text, lang in zip(texts, langs):
                known = lang if lang in P.PARAMETERS else "default"
                out.append(None if text is None else repaired(text, int(P.PARAMETERS[known]["long_word"]), None if known in P.KEEP_FRAGMENTS else bad))
            yield pd.Series(out, dtype=object)

    done = run(c, F.col(lang) if isinstance(lang, str) else lang)
    return T.plain_marks(done) if marks else done


def vote(words: list[str], lists: dict[str, frozenset]) -> tuple[str, float]:
    hits = [(sum(map(v.__contains__, words)), k) for k, v in lists.items()]
    total = sum(n for n, _ in hits)
    most = max(n for n, _ in hits)
    return (min(k for n, k in hits if n == most), most / total) if total else ("unknown", 0.0)


def vote_language(c: Column, lists: dict[str, list[str]] | None = None) -> Column:
    """struct(lang, score): the language most of whose stop words a text has, and its share of all hits; the default for a plug-in model."""
    sets = {k: frozenset(v) for k, v in sorted((lists or P.STOPWORDS).items())}

    @F.arrow_udf("lang string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            parts = [[(None, None) if t is None else vote(words_of(t), sets) for t in b.slice(at, ROWS).to_pylist()] for at in range(0, len(b), ROWS)]
            langs, scores = zip(*itertools.chain.from_iterable(parts)) if len(b) else ((), ())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return run(c)


Identify = Callable[[list[str]], list[tuple[str, float]]]


def language_info(text: Column, make: Callable[[], Identify] | None = None) -> Column:
    """struct(lang, score, lines: array of (lang, score)): the prediction for a text and for each of its lines; without a model by stop words."""
    sets = {k: frozenset(v) for k, v in sorted(P.STOPWORDS.items())}

    @F.pandas_udf("lang string, score double, lines array<struct<lang: string, score: double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identify = make() if make else lambda texts: [vote(words_of(t), sets) for t in texts]
        for b in batches:
            rows = []
            for t in b:
                if t is None:
                    rows.append((None, None, None))
                    continue
                (whole, *lines) = identify([t.replace("\n", " "), *t.split("\n")])
                rows.append((*whole, [{"lang": k, "score": s} for k, s in lines]))
            yield pd.DataFrame(rows, columns=["lang", "score", "lines"]).astype({"score": "float64"})

    return run(text)


def tokenization(text: Column, make: Callable[[], Callable[[str], list[str]]], join: bool = False) -> Column:
    """The pieces that a tokenizer, made once per worker, cuts a text into; joined by blanks if asked."""
    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut = make()
        for b in batches:
            yield pd.Series([None if t is None else list(cut(t)) for t in b], dtype=object)

    return F.array_join(run(text), " ") if join else run(text)


Scorer = Callable[[list[str]], list[float]]


def model_score(make: Callable[[], Scorer], text: Column) -> Column:
    """Column of a model's score; the model is made once per Python worker, when first asked."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for b in batches:
            some = b.notna()
            out = pd.Series(np.nan, index=b.index, dtype="float64")
            if some.any():
                out[some] = model(b[some].tolist())
            yield out

    return score(text)


def perplexity(log10_sum: Column, tokens: Column) -> Column:
    """Perplexity of a text from the sum of its lines' log10 scores and its tokens (each line's end counts as one)."""
    return F.round(F.pow(F.lit(10.0), -T.ratio(log10_sum, tokens)), 1)


def repetition_maps(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Character ratios for n of 2 to 15 and word ratios for n of 3 to 10 as maps, rounded to four digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                ids, texts = b.column(0).slice(at, ROWS), [t or "" for t in b.column(1).slice(at, ROWS).to_pylist()]
                chars, words = [], []
                for part in chunks([len(t) for t in texts]):
                    w = [words_of(t) for t in texts[part]]
                    chars.append(_all_n(_char_shares, char_codes(texts[part]), [len(t) for t in texts[part]], MAPS_CHAR))
                    words.append(_all_n(_word_shares, word_codes(w), [len(x) for x in w], MAPS_WORD))
                maps = []
                for ns, found in ((MAPS_CHAR, chars), (MAPS_WORD, words)):
                    values = [round(x, 4) for x in np.concatenate(found).ravel().tolist()]
                    places = pa.array(range(0, len(values) + 1, len(ns)), pa.int32())
                    maps.append(pa.MapArray.from_arrays(places, pa.array(list(ns) * len(texts), pa.int32()), pa.array(values, pa.float64())))
                yield pa.RecordBatch.from_arrays([ids, *maps], names=[id_col, "char_repetition", "word_repetition"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, "text").mapInArrow(run, f"{id_col} {kind}, char_repetition map<int,double>, word_repetition map<int,double>")
