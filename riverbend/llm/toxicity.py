"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms (full width, mathematical letters) and accents to
plain letters, invisible characters out, lower case, look-alike letters of other scripts to Latin
ones, digits or signs that stand before or between letters to the letters they imitate, and
letters set apart one by one back together. The
lexicon is learned: whole words and word beginnings that stand in ``MIN_DOCS`` toxic and few
other labelled texts, each weighed by its log odds. A beginning stands for its longer forms unless
one of these has nearly all of its texts. Exception phrases, a match with the word before or
after it, that clean texts use and toxic ones hardly do, cancel the match. A document's
evidence is the weight of its matches, and that weight by length; a logistic curve through
the two, fitted on the same texts, is the score.

The lexicon is fitted on a bounded sample: at most about ``SAMPLE_LABELS`` labelled texts,
chosen by a hash of the id, equal texts once (toxic if at least half of their labels are). What is
collected from it is bounded by the sample; every pattern and phrase that passes is kept, unless
a caller sets ``MAX_PATTERNS``. Beginnings have up to ``MAX_PREFIX`` letters, whole words any number.
Scores cover every document.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import held_out, written
from riverbend.llm.pieces import groups

SAMPLE_LABELS = 40_000
MAX_PATTERNS: int | None = None  # no limit
SAMPLE_TASKS = 64
MIN_PREFIX, MAX_PREFIX = 4, 12
MIN_DOCS, MIN_WEIGHT = 3, 2.5
HOLD = 5, 0  # documents of crc32(id) mod 5 = 0 are never learned from

#: Letters of other scripts that look like Latin ones, and the signs that imitate letters (fixed values).
LOOK_ALIKE = str.maketrans(dict(zip("аеорсухіјѕԁһӏкмтвнԛԝαορνικτυχеⅼıłøđħŧæœßгпԍӡɡɑɩʟɪʏøᴀʙᴄᴅᴇᴊᴋᴍɴᴏᴘᴛᴜᴠᴡᴢ",
                               "aeopcyxijsdhlkmtbhqwaopviktuxelilodhtaosrngzgailiyoabcdejkmnoptuvwz")))
IMITATE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
IMITATORS = "0134579@$!"
#: One or two signs with a letter on either side, or one at the beginning of a word of two letters or more.
SIGNS = re.compile(r"(?<=[^\W\d_])[0134579@$!]{1,2}(?=[^\W\d_])|(?<!\w)[0134579@$!](?=[^\W\d_]{2})")
WORD = re.compile(r"[^\W\d_]+")


#: Accents (combining marks) and characters without a shape of their own (fixed values).
INVISIBLE = re.compile("[\u0300-\u036f\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f"
                       "\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]")
#: Four letters or more with the same sign between each two, standing alone.
APART = re.compile(r"(?<![^\W\d_])[^\W\d_]([ .\-_*·])[^\W\d_]\1[^\W\d_](?:\1[^\W\d_])+(?![^\W\d_])")


def fold(text: str) -> str:
    if not text.isascii():
        # once more without marks: letters that compatibility forms have left in upper case
        text = INVISIBLE.sub("", unicodedata.normalize("NFKD", text)).lower()
        text = INVISIBLE.sub("", text).translate(LOOK_ALIKE)
    else:
        text = text.lower()
    if any(c in text for c in IMITATORS):
        text = SIGNS.sub(lambda m: "".join(IMITATE.get(c, c) for c in m[0]), text)
    return APART.sub(lambda m: m[0].replace(m[1], ""), text)


@dataclass
class Lexicon:
    """``patterns``: a word beginning, or a whole word with ``$`` after it, and its weight."""

    patterns: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (-2.0, 0.0, 0.0)

    def plain(self) -> tuple:
        """For broadcasting: values only, so that workers need no module to read it."""
        return self.patterns, self.exceptions, self.curve

    def automaton(self) -> ahocorasick.Automaton | None:
        out = ahocorasick.Automaton()
        for p in self.patterns:
            out.add_word(p.removesuffix("$"), p.removesuffix("$"))
        if not self.patterns:
            return None
        out.make_automaton()
        return out


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, lexicon.automaton()

    def hits(self, text: str) -> Iterator[tuple[float, int, int]]:
        """(weight, first character, end) of each matched word of a folded text, the heaviest
        pattern of each word."""
        if self.automaton is None:
            return
        weights, last = self.lexicon.patterns, None
        for end, p in self.automaton.iter(text):
            start = end + 1 - len(p)
            if start and text[start - 1].isalpha():
                continue
            weight = weights.get(p, 0.0)
            whole = end + 1 == len(text) or not text[end + 1].isalpha()
            if whole:
                weight = max(weight, weights.get(p + "$", 0.0))
            if not weight:
                continue
            if last and last[1] == start:
                last = (max(weight, last[0]), start, max(end + 1, last[2]))
                continue
            if last:
                yield last
            last = (weight, start, end + 1)
        if last:
            yield last

    def phrases(self, text: str, start: int, end: int) -> tuple[str, str]:
        """The matched word with the one before it, and with the one after it."""
        stop = end
        while stop < len(text) and text[stop].isalpha():
            stop += 1
        word = text[start:stop]
        end = start
        while end and not text[end - 1].isalpha():
            end -= 1
        first = end
        while first and text[first - 1].isalpha():
            first -= 1
        after = WORD.search(text, stop)
        return f"{text[first:end] or '^'} {word}", f"{word} {after[0] if after else '^'}"

    def evidence(self, text: str) -> tuple[float, float]:
        """Weight of the matches that no exception cancels, and that weight by 100 words."""
        text, total = fold(text), 0.0
        for weight, start, end in self.hits(text):
            if not self.lexicon.exceptions or not self.lexicon.exceptions.intersection(
                    self.phrases(text, start, end)):
                total += weight
        if not total:
            return 0.0, 0.0
        return math.log1p(total), math.log1p(100 * total / (text.count(" ") + text.count("\n") + 1))

    def score(self, text: str) -> float:
        a, b, c = self.lexicon.curve
        x, y = self.evidence(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def patterns_of(text: str) -> set[str]:
    out = set()
    for w in set(WORD.findall(fold(text))):
        out.add(w + "$")
        out.update(w[:n] for n in range(MIN_PREFIX, min(len(w), MAX_PREFIX) + 1))
    return out


def _counted(rows: DataFrame, make: Callable[[], Callable[[str], set[str]]]) -> DataFrame:
    """``(p, toxic, n)``: in how many texts of a label each item of ``make()(text)`` stands.
    Counts are summed in the task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        of = make()

        def out() -> Iterator[pa.RecordBatch]:
            keys = list(counts)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                     pa.array([counts[k] for k in keys], pa.int64())], ["p", "toxic", "n"])
            counts.clear()

        for b in batches:
            for text, toxic in zip(b.column("t"), b.column("toxic")):
                counts.update((p, toxic.as_py()) for p in of(text.as_py() or ""))
                if len(counts) > 500_000:
                    yield from out()
        yield from out()

    return (rows.select("t", "toxic").mapInArrow(run, "p string, toxic int, n bigint")
            .groupBy("p", "toxic").agg(F.sum("n").alias("n")))


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """The patterns kept of those counted, with their weights."""
    def weight(p: str) -> float:
        return math.log((toxic[p] + 0.5) / (n_toxic + 1)) - math.log((clean.get(p, 0) + 0.5) / (n_clean + 1))

    good = {p: weight(p) for p in toxic if weight(p) >= MIN_WEIGHT}
    longer: Counter = Counter()  # texts of the best pattern that is one letter longer, or the whole word
    for p in good:
        short = p[:-1]
        longer[short] = max(longer[short], toxic[p])
    kept: dict[str, float] = {}
    for p in sorted(good, key=lambda p: (len(p.removesuffix("$")), not p.endswith("$"), p)):
        stem = p.removesuffix("$")
        if p == stem and longer[p] >= 0.95 * toxic[p]:
            continue  # a longer one says the same and matches less else
        if any(good[p] < kept[stem[:n]] + 1 for n in range(MIN_PREFIX, len(stem) + 1) if stem[:n] in kept and stem[:n] != p):
            continue  # a kept beginning matches it already
        kept[p] = good[p]
    return dict(sorted(kept.items(), key=lambda x: (-toxic[x[0]] * x[1], x[0]))[:MAX_PATTERNS])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Newton steps on the three coefficients."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_labels: int = SAMPLE_LABELS) -> Lexicon:
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & F.col("i").isNotNull() & ~held_out("i", *HOLD))
    known = known.groupBy("i").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    share = min(1.0, sample_labels / max(1, total))
    known = known.where(F.pmod(F.xxhash64("i", F.lit("sample")), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    # about sample_labels ids of two numbers, by the hash above
    rows = rows.join(F.broadcast(known), "i").select("t", "toxic", F.xxhash64("t").alias("h"))
    rows = rows.groupBy("h").agg(F.min("t").alias("t"), (F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    rows = written(rows.repartition(SAMPLE_TASKS, "h"), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon(curve=(math.log((n_toxic + 0.5) / (n_clean + 0.5)), 0.0, 0.0) if n_toxic + n_clean else (-2.0, 0.0, 0.0))
    sc = docs.sparkSession.sparkContext
    counted = _counted(rows, lambda: patterns_of).groupBy("p").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    weight = F.log((F.col("bad") + 0.5) / (n_toxic + 1)) - F.log((F.col("good") + 0.5) / (n_clean + 1))
    # a word has at most ten patterns, itself and its beginnings; bounded by the sample
    found = counted.where(F.col("bad") >= MIN_DOCS).where(weight >= MIN_WEIGHT - 1e-9).orderBy("p").collect()
    toxic, clean = {r["p"]: r["bad"] for r in found}, {r["p"]: r["good"] for r in found}
    lexicon = Lexicon(choose(toxic, clean, n_toxic, n_clean))
    first = sc.broadcast(lexicon.plain())

    def around() -> Callable[[str], set[str]]:
        m = Matcher(Lexicon(*first.value))

        def phrases(text: str) -> set[str]:
            text = fold(text)
            return {p for _, a, b in m.hits(text) for p in m.phrases(text, a, b)}
        return phrases

    phrases = _counted(rows, around).groupBy("p").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    # two for each match in the sample
    phrases = phrases.where((F.col("good") >= MIN_DOCS) & (F.col("bad") * n_clean * 2 < F.col("good") * n_toxic)).collect()
    lexicon.exceptions = frozenset(r["p"] for r in phrases)
    second = sc.broadcast(lexicon.plain())

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(Lexicon(*second.value))
        for b in batches:
            pairs = [m.evidence(t.as_py() or "") for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.float64()),
                                              pa.array([p[1] for p in pairs], pa.float64()), b.column("toxic")], ["x", "y", "toxic"])

    # about sample_labels rows of three numbers, those without a match as one count
    pairs = (rows.select("t", "toxic").mapInArrow(evidence, "x double, y double, toxic int")
             .groupBy("x", "y", "toxic").count().orderBy("x", "y", "toxic").collect())
    x = np.array([[r["x"], r["y"]] for r in pairs for _ in range(r["count"])])
    y = np.array([r["toxic"] for r in pairs for _ in range(r["count"])], float)
    lexicon.curve = logistic(x, y)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row.

    A null text scores as the empty one: the curve without evidence. Repeated rows come back
    each; ties of patterns in a word go to the heavier; without labels of both kinds the
    score is the share of toxic labels, or about 0.12 without labels; an empty table gives
    no rows; only the two named columns are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon.plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(Lexicon(*shared.value))
        for b in batches:
            scores = [m.score(t) for texts in groups(b.column("t")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                ["doc_id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"doc_id {kind}, score double, predicted int"))
