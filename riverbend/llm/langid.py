"""Language identification: script ranges, word scores and Viterbi spans.

Training sums, per language, the counts of hashed character pairs and triples of its words
(with their ends marked) and of whole words, and the letters it writes in each script. A
word's script leaves as candidates the languages that write at least ``MIN_SCRIPT_SHARE`` of
their letters in it; each candidate scores the mean log probability of the word's features
over that of all languages, times the root of their number. The Viterbi path through the
words pays ``SWITCH`` for a change of language, so stray words do not break a span. The
prediction is the language whose spans hold most letters; the share of all letters that lie in
its spans, in words of a script that some language writes, is the score.

The model is fitted on a bounded sample: about ``SAMPLE_DOCS`` training documents a language,
chosen by a hash of the id; a language with fewer gives all. It has ``BUCKETS`` rows and a
column for every language with training rows; more than ``MOST_LANGS`` are refused. With more
than ``FEW_LANGS``, fewer words are worked on at a time. All else covers all documents.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import held_out, written
from riverbend.llm.pieces import groups

SAMPLE_DOCS, BUCKETS = 8_000, 1 << 15  # buckets: the top 15 bits of a hash
FEW_LANGS, MOST_LANGS = 64, (1 << 15) - 1  # a language's number has 16 bits
SWITCH, MIN_SCRIPT_SHARE, ALPHA = 6.0, 0.01, 0.5
MAX_WORDS, SLICE = 200_000, 1 << 15  # of a task's word table, which is then emptied; of words worked on at once
HOLD = 4, 2  # documents of crc32(id) mod 4 = 2 are never learned from

#: First code point of each range and the script's name (fixed values, from the Unicode blocks).
SCRIPTS = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"), (0xFF21, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x323B0, "other"),
]
NAMES = sorted({name for _, name in SCRIPTS})
STARTS = [start for start, _ in SCRIPTS]


NUMBER = [NAMES.index(name) for _, name in SCRIPTS]
LATIN = NAMES.index("latin")
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|-_/0123456789"


def script_of(letter: str) -> int:
    """Number of the letter's script in ``NAMES``."""
    return LATIN if letter < "\u0370" else NUMBER[max(0, bisect_right(STARTS, ord(letter)) - 1)]


def letters_of(word: str) -> str:
    word = word.strip(PUNCTUATION)
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the pairs and triples of each lower-case word with its ends marked, and
    of the whole word; and where each word's buckets begin. No word may be empty."""
    text = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mix = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        pairs = (codes[:-1] * np.uint64(0x10001) + codes[1:]) * mix
        triples = (pairs[:-1] ^ (codes[2:] << np.uint64(7))) * mix
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        whole = np.add.reduceat((codes + np.uint64(1)) * mix * (place.astype(np.uint64) * 2 + np.uint64(1)) ** 3, starts) * mix
    # of the word's first code point on: one pair a code point but the last, one triple but the last two, itself
    out = np.empty((len(codes), 2), np.uint64)
    out[:-1, 0], out[:-2, 1] = pairs, triples
    keep = np.ones((len(codes), 2), bool)
    keep[ends - 1] = False
    keep[ends - 2, 1] = False
    out[ends - 1, 0], keep[ends - 1, 0] = whole, True
    return (out[keep] >> np.uint64(64 - 15)).astype(np.int64), np.cumsum(2 * sizes - 2) - (2 * sizes - 2)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS x languages: log probability over the mean language
    writes: np.ndarray   # scripts x languages: is the language written in it?

    def plain(self) -> tuple:
        """For broadcasting: values only, so that workers need no module to read it."""
        return self.langs, self.weights, self.writes


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS) -> Model:
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    rows = rows.where(F.col("l").isNotNull() & F.col("i").isNotNull() & ~held_out("i", *HOLD))
    sizes = written(rows.groupBy("l").count(), "languages")
    langs = sorted(r["l"] for r in sizes.select("l").limit(MOST_LANGS + 1).collect())
    if len(langs) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(NAMES), 0), bool))
    scale = 1 << 20
    shares = sizes.select("l", F.least(F.lit(scale), F.ceil(F.lit(float(scale * sample_docs)) / F.col("count"))).alias("share"))
    # at most MOST_LANGS rows of two values
    chosen = rows.join(F.broadcast(shares), "l").where(F.pmod(F.xxhash64("i"), F.lit(scale)) < F.col("share"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            lang, key, n = [], [], []
            for name, counter in words.items():
                scripts, found = Counter(), [(x, k) for word, k in counter.items() if (x := letters_of(word))]
                if not found:
                    continue
                for x, k in found:
                    scripts[script_of(x[0])] += k * len(x)
                grams = np.zeros(BUCKETS, np.int64)
                for at in range(0, len(found), SLICE):
                    part = found[at: at + SLICE]
                    buckets, start = features([x for x, _ in part])
                    times = np.repeat([k for _, k in part], np.diff(np.append(start, len(buckets))))
                    grams += np.bincount(buckets, weights=times, minlength=BUCKETS).astype(np.int64)
                at = np.nonzero(grams)[0]
                key += [*at.tolist(), *[-1 - s for s in scripts]]
                n += [*grams[at].tolist(), *scripts.values()]
                lang += [name] * (len(key) - len(lang))
            words.clear()
            if lang:
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(key, pa.int32()),
                                                  pa.array(n, pa.int64())], ["l", "k", "n"])

        for b in batches:
            for text, lang in zip(b.column("t"), b.column("l")):
                words[lang.as_py()].update((text.as_py() or "").lower().split())
            if sum(map(len, words.values())) > MAX_WORDS:
                yield from out()
        yield from out()

    counts = (chosen.select("t", "l").mapInArrow(run, "l string, k int, n bigint")
              .groupBy("l", "k").agg(F.sum("n").alias("n")))
    # at most BUCKETS + scripts rows of three numbers a language, a partition at a time
    column = {name: k for k, name in enumerate(langs)}
    grams, scripts = np.full((BUCKETS, len(langs)), ALPHA), np.zeros((len(NAMES), len(langs)))
    for r in counts.toLocalIterator():
        if r["k"] >= 0:
            grams[r["k"], column[r["l"]]] += r["n"]
        else:
            scripts[-1 - r["k"], column[r["l"]]] += r["n"]
    logs = np.log(grams / grams.sum(axis=0))
    weights = (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)
    return Model(langs, weights, scripts >= np.maximum(1, MIN_SCRIPT_SHARE * scripts.sum(axis=0)))


def smaller(size: int, langs: int) -> int:
    """A bound that holds for ``FEW_LANGS``, for more: what is kept of a word grows with them."""
    return max(1, size * FEW_LANGS // max(FEW_LANGS, langs))


class Words:
    """Scores of the distinct words a task has met."""

    def __init__(self, model: Model):
        self.model, self.place = model, defaultdict()
        self.place.default_factory = self.place.__len__
        self.scores = np.zeros((0, len(model.langs)), np.float32)
        self.letters, self.known = np.zeros(0, np.int64), np.zeros(0, bool)

    def _scored(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores by language and letters of each word."""
        scores, sizes = np.zeros((len(new), len(self.model.langs)), np.float32), np.zeros(len(new), np.int64)
        letters = [letters_of(word) for word in new]
        at = np.nonzero(np.fromiter(map(len, letters), np.int64, len(new)))[0]
        if len(at) and self.model.langs:
            full = [letters[k] for k in at]
            buckets, start = features(full)
            n = np.diff(np.append(start, len(buckets)))
            own = np.add.reduceat(self.model.weights[buckets], start, axis=0) / np.sqrt(n)[:, None]
            writes = self.model.writes[np.fromiter((script_of(x[0]) for x in full), np.int64, len(full))]
            # the script narrows the candidates; one that no language writes says nothing
            own = np.where(writes, own, np.minimum(-50, own.min(axis=1, keepdims=True)))
            scores[at] = np.where(writes.any(axis=1, keepdims=True), own, 0)
        sizes[at] = [len(letters[k]) for k in at]
        return scores, sizes

    def lookup(self, texts: list[str]) -> list[list[int]]:
        if len(self.place) > smaller(MAX_WORDS, len(self.model.langs)):
            self.__init__(self.model)
        old = len(self.place)
        ids = [list(map(self.place.__getitem__, t.lower().split())) for t in texts]
        new = list(self.place)[old:]
        step = smaller(SLICE, len(self.model.langs))
        found = [self._scored(new[k: k + step]) for k in range(0, len(new), step)] or [self._scored([])]
        scores, sizes = (np.concatenate(x) for x in zip(*found))
        self.scores, self.letters = np.concatenate([self.scores, scores]), np.concatenate([self.letters, sizes])
        self.known = np.concatenate([self.known, (scores != 0).any(axis=1)])
        return ids


@dataclass
class Paths:
    """Texts of a group, longest first: ``order`` has their numbers; the word numbers and best
    languages of all of them lie end to end."""

    order: list[int]
    sizes: np.ndarray
    starts: np.ndarray
    words: np.ndarray
    langs: np.ndarray


def viterbi(ids: list[list[int]], scores: np.ndarray, switch: float = SWITCH) -> Paths:
    """Best language of every word of every text. All texts step together, word by word, so
    a step is one operation on an array."""
    order = sorted(range(len(ids)), key=lambda k: -len(ids[k]))
    sizes = np.array([len(ids[k]) for k in order], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.fromiter(chain.from_iterable(ids[k] for k in order), np.int64, int(sizes.sum()))
    path = np.zeros(len(flat), np.int16)
    if not len(flat) or not scores.shape[1]:
        return Paths(order, sizes, starts, flat, path)
    longest = int(sizes[0])
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), "right")
    state = np.zeros(len(sizes), np.int64)  # the last word's language, of texts that have ended
    best = scores[flat[starts[:active[0]]]].astype(np.float64)
    back, leap = [], []
    for t in range(1, longest):
        m = int(active[t])
        if m < len(best):
            state[m: len(best)] = best[m:].argmax(axis=1)
            best = best[:m]
        top = best.argmax(axis=1)
        jump = (best.max(axis=1) - switch)[:, None]
        back.append(jump > best)
        leap.append(top.astype(np.int16))
        best = np.maximum(best, jump) + scores[flat[starts[:m] + t]]
    state[: len(best)] = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        m = int(active[t])
        now = state[:m]
        path[starts[:m] + t] = now
        if t:
            moved = back[t - 1][np.arange(m), now]
            if moved.any():
                state[:m] = np.where(moved, leap[t - 1], now)
    return Paths(order, sizes, starts, flat, path)


def judge(paths: Paths, words: Words) -> list[tuple[str, float]]:
    """(language, score) of each text, in the order they were given."""
    langs, out = words.model.langs, [("und", 0.0)] * len(paths.order)
    n = int((paths.sizes > 0).sum())  # the texts without words are the last
    if not langs or not n:
        return out
    letters, starts = words.letters[paths.words], paths.starts[:n]
    share = np.stack([np.add.reduceat(np.where(paths.langs == k, letters, 0), starts) for k in range(len(langs))], axis=1)
    total = share.sum(axis=1)
    best = share.argmax(axis=1)
    mine = paths.langs == np.repeat(best, paths.sizes[:n])
    known = np.add.reduceat(np.where(mine & words.known[paths.words], letters, 0), starts)
    for d in range(n):
        if total[d]:
            out[paths.order[d]] = langs[best[d]], float(known[d] / total[d])
    return out


def spans(paths: Paths, langs: list[str]) -> list[list[dict]]:
    """First word, word after the last, and language of each span of each text."""
    out: list[list[dict]] = [[]] * len(paths.order)
    for d, k in enumerate(paths.order):
        path = paths.langs[paths.starts[d]: paths.starts[d] + paths.sizes[d]]
        cuts = [0, *(np.nonzero(path[1:] != path[:-1])[0] + 1).tolist(), len(path)]
        out[k] = [{"first": a, "end": b, "lang": langs[path[a]]} for a, b in zip(cuts, cuts[1:]) if a < b]
    return out


def _judged(texts: pa.Array, words: Words, with_spans: bool = False) -> Iterator[tuple[tuple[str, float], list[dict]]]:
    for part in groups(texts, smaller(8 << 20, len(words.model.langs))):
        paths = viterbi(words.lookup(part), words.scores)
        found = judge(paths, words)
        of = spans(paths, words.model.langs) if with_spans and words.model.langs else [[]] * len(found)
        yield from ((j, s if j[0] != "und" else []) for j, s in zip(found, of))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             with_spans: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, and its ``spans`` (first word, end, language)
    if asked for. Words are split at white space.

    A null text, an empty one, or one without a letter: ``und``, score 0, no spans. Letters of
    a script that no learned language writes count for the language of their span but not for
    the score. Ties go to the first language by name. With no training rows every text is
    ``und``. Repeated rows each come back; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(Model(*shared.value))
        for b in batches:
            found = list(_judged(b.column("t"), words, with_spans))
            out = [b.column("i"), pa.array([j[0] for j, _ in found], pa.string()),
                   pa.array([j[1] for j, _ in found], pa.float64())]
            if with_spans:
                kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                out.append(pa.array([s for _, s in found], kind))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "lang_pred", "score", *["spans"] * with_spans])

    kind = docs.schema[id_col].dataType.simpleString()
    more = ", spans array<struct<first: int, end: int, lang: string>>" if with_spans else ""
    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"doc_id {kind}, lang_pred string, score double{more}"))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language of at least ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(Model(*shared.value))
        for b in batches:
            keep = [lang != "und" and score >= min_score for (lang, score), _ in _judged(b.column(at), words)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
