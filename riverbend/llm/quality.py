"""Quality rules: distribution divergence from language references.

Every language of the table has two reference histograms over all of its documents: the
shares of character classes, and the shares of its ``COMMON`` most frequent words (of at least ``MIN_COMMON`` occurrences), with one
class for all others. A document is compared with the references of its own language (a
null language: those of the whole table) by the
Jensen-Shannon distance, the square root of the divergence in bits, 0 to 1. It goes if

* it has at least ``MIN_CHARS`` characters and its character classes are farther than
  ``MAX_CHAR_JS``, or
* it has at least ``MIN_WORDS`` words and its common words are farther than ``MAX_WORD_JS``
  and the chance distance of a text of that length, ``WORD_NOISE / sqrt(words)``, together.

Below those lengths a histogram says nothing, and the comparison passes. DataFrame functions
only: a document's arrays are worked on in its own row; no word leaves its task but in the
partial sums of the word counts. The references of the ``MAX_LANGS`` largest languages are
broadcast; the documents of all others meet theirs in a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbend.llm.common import SPACES, literal_table, written

COMMON, MIN_COMMON, MAX_LANGS = 32, 3, 64
SALTS = 16  # of a language in the shuffle join: it has at most a part of MAX_LANGS of the words, a task a part of that
MIN_CHARS, MIN_WORDS = 200, 50
MAX_CHAR_JS, MAX_WORD_JS, WORD_NOISE = 0.33, 0.28, 1.0
#: Of the words' characters: lower-case letters, upper-case letters, other letters and marks,
#: digits, symbols, the rest.
CLASSES = 6
ALL = "*"


def _size(text: Column, drop: str) -> Column:
    return F.char_length(F.regexp_replace(text, drop, "")).cast("long")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _classes(odd: Column, word_chars: Column) -> Column:
    """Counts of the classes from what is neither a lower-case letter nor white space."""
    counts = [_size(odd, drop) for drop in (r"[^\p{Lu}\p{Lt}]+", r"[^\p{Lo}\p{Lm}\p{M}]+", r"[^\p{Nd}]+", r"[^#*$%&|<>]+")]
    size = F.char_length(odd).cast("long")
    return F.array(word_chars - size, *counts, size - sum(counts))


def _features(docs: DataFrame, text_col: str, lang_col: str, carry: list[str]) -> DataFrame:
    """``row``, ``lang``, words ``w``, their hashes ``hw`` and the base counts of every row."""
    rows = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.col(lang_col).alias("lang"))
    rows = rows.select("row", "lang", _words(F.col("t")).alias("w"), F.char_length("t").cast("long").alias("n_chars"),
                       F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
                       # short in prose
                       F.regexp_replace("t", r"[\p{Ll}\x20\x09-\x0D]+", "").alias("odd"))
    rows = rows.select(
        "row", "lang", "w", "odd", "n_chars", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("hw"))
    return rows.withColumn("classes", _classes(F.col("odd"), F.col("word_chars"))).drop("odd")


def _repeats(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``, the words in 3-word windows found twice or more.

    Windows are hashed; only a document whose hashes repeat has them sorted, with their
    places in the low bits, and equal neighbours are compared word by word.
    """
    rows = rows.withColumn("h3", F.expr("""CASE WHEN n_words < 3 THEN CAST(array() AS array<bigint>) ELSE
        transform(sequence(0, CAST(n_words AS int) - 3), i -> xxhash64(get(hw, i), get(hw, i + 1), get(hw, i + 2))) END"""
        )).withColumn("bits", F.length(F.bin("n_words"))).withColumn("mask", F.expr("shiftleft(1L, bits) - 1"))
    rows = rows.withColumn("sorted", F.expr("""CASE WHEN size(array_distinct(h3)) = size(h3)
        THEN CAST(array() AS array<bigint>)
        ELSE sort_array(transform(h3, (h, i) -> shiftleft(h, bits) | i)) END""")).drop("h3")
    equal = """shiftright(x, bits) = shiftright(get(sorted, {n}), bits)
        AND get(w, CAST(x & mask AS int)) = get(w, CAST(get(sorted, {n}) & mask AS int))
        AND get(w, CAST(x & mask AS int) + 1) = get(w, CAST(get(sorted, {n}) & mask AS int) + 1)
        AND get(w, CAST(x & mask AS int) + 2) = get(w, CAST(get(sorted, {n}) & mask AS int) + 2)"""
    rows = rows.withColumn("twice", F.expr(f"""sort_array(transform(filter(sorted, (x, k) ->
        (k + 1 < size(sorted) AND {equal.format(n='k + 1')}) OR (k > 0 AND {equal.format(n='k - 1')})), x -> x & mask))"""))
    # each marked window covers three words, or as many as there are up to the next one
    return rows.withColumn("n_repeat_words", F.expr("""CASE WHEN size(twice) = 0 THEN 0L ELSE aggregate(
        sequence(0, size(twice) - 1), 0L,
        (sum, i) -> sum + least(3L, coalesce(get(twice, i + 1), get(twice, i) + 3) - get(twice, i))) END""")).drop(
            "sorted", "twice", "bits", "mask", "w")


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[tuple], DataFrame | None]:
    """``(lang, is it the whole table, class shares, hashes of the common words, their shares
    with that of all others first)`` of the ``MAX_LANGS`` largest languages and of the whole table, over all
    documents: at most ``MAX_LANGS + 1`` rows of ``CLASSES + 2 * COMMON + 1`` values, whatever the input.
    And the same of all other languages, if there are any, as a table ``lang, q_class, q_word, keys``."""
    words = docs.select(F.col(lang_col).alias("lang"),
                        F.explode(_words(F.coalesce(F.col(text_col), F.lit("")))).alias("word"))
    counts = written(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    # The limit is also taken before the window's shuffle: no language's words meet in one task.
    own = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.where(f"n >= {MIN_COMMON}").withColumn("k", F.row_number().over(own)).where(f"k <= {COMMON}").select(
        "lang", "word", "n", F.xxhash64("word").alias("h"))
    size = F.char_length("word").cast("long")
    classed = counts.withColumn("odd", F.regexp_replace("word", r"\p{Ll}+", "")).select(
        "lang", "n", F.when(F.col("odd") == "", F.array(size, *[F.lit(0).cast("long")] * (CLASSES - 1)))
        .otherwise(_classes(F.col("odd"), size)).alias("c"))
    # one row a language, the null one too
    sums = written(classed.groupBy("lang").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.col("n") * F.get("c", F.lit(k))) for k in range(CLASSES)]).alias("classes")), "language-sums")
    whole = sums.agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.get("classes", F.lit(k))) for k in range(CLASSES)]).alias("classes")).first()
    if whole["n"] is None:
        return [], None
    largest = sums.where(F.col("lang").isNotNull()).orderBy(F.desc("n"), "lang").limit(MAX_LANGS + 1).collect()
    more, largest = len(largest) > MAX_LANGS, largest[:MAX_LANGS]
    pooled = (counts.groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {MIN_COMMON}")
              .orderBy(F.desc("n"), "word").limit(COMMON).select("word", "n", F.xxhash64("word").alias("h")).collect())
    held = [r["lang"] for r in largest]
    common: dict = {lang: [] for lang in held}
    for r in top.where(F.col("lang").isin(held)).collect() if held else []:
        common[r["lang"]].append(r)
    out = []
    for lang, chars, n, found in [(ALL, whole["classes"], whole["n"], pooled), *(
            (r["lang"], r["classes"], r["n"], common[r["lang"]]) for r in sorted(largest, key=lambda r: r["lang"]))]:
        found = sorted(found, key=lambda r: (-r["n"], r["word"]))
        total = sum(chars) or 1
        out.append((lang, chars is whole["classes"], [c / total for c in chars], [r["h"] for r in found],
                    [(n - sum(r["n"] for r in found)) / n, *(r["n"] / n for r in found)]))
    if not more:
        return out, None
    own_words = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word", "h"))).alias("top"))
    rest = sums.where(F.col("lang").isNotNull() & ~F.col("lang").isin(held)).join(own_words, "lang", "left")
    rest = rest.withColumn("top", F.expr("coalesce(top, CAST(array() AS array<struct<m: bigint, word: string, h: bigint>>))"))
    return out, written(rest.select(
        "lang", F.expr("transform(classes, x -> CAST(x AS double) / greatest(1L, aggregate(classes, 0L, (a, y) -> a + y)))").alias("q_class"),
        F.expr("""concat(array(CAST(n + aggregate(top, 0L, (a, x) -> a + x.m) AS double) / n),
            transform(top, x -> CAST(-x.m AS double) / n))""").alias("q_word"),
        F.expr("transform(top, x -> x.h)").alias("keys")), "small-references")


def _lookup(hashes: list[int]) -> tuple[int, list[int], list[int]]:
    """A shift and a table size that send the hashes to different slots, the hash in each
    slot, and its place in the list, from 1. An empty slot holds the first hash, whose own
    slot is another. Different hashes are apart in some window of at most 17 bits or so."""
    for bits in range(7, 24):
        for shift in range(64 - bits):
            slots = [(h % (1 << 64) >> shift) % (1 << bits) for h in hashes]
            if len(set(slots)) == len(slots):
                keys, places = [(hashes or [0])[0]] * (1 << bits), [0] * (1 << bits)
                for k, (slot, h) in enumerate(zip(slots, hashes)):
                    keys[slot], places[slot] = h, k + 1
                return shift, keys, places
    raise ValueError("two common words have one hash")


def _js_term(p: str, q: str) -> str:
    part = "CASE WHEN {a} > 0 THEN 0.5D * {a} * log2(2 * {a} / ({p} + {q})) ELSE 0D END"
    return f"({part.format(a=p, p=p, q=q)} + {part.format(a=q, p=p, q=q)})"


def rated(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``carry``, or of all), the base counts, ``base_failed``, ``char_js``,
    ``word_js`` and ``kept`` of every row.

    A null text has no words and fails the base rule, as does an empty one; ties among the
    common words go to the smaller word; repeated rows are rated each; an empty table gives
    no rows; columns of any other name pass in ``row``.
    """
    spark = docs.sparkSession
    refs, rest = references(docs, text_col, lang_col)
    rows = _features(docs, text_col, lang_col, docs.columns if carry is None else carry)
    if not refs:
        refs = [(ALL, True, [1.0] + [0.0] * (CLASSES - 1), [], [1.0])]
    table = literal_table(spark, [(ALL if pooled else f"={lang}", chars, shares, *_lookup(hashes))
                                  for lang, pooled, chars, hashes, shares in refs],
                          "ref string, q_class array<double>, q_word array<double>, shift int, "
                          "keys array<bigint>, key_places array<int>")
    named = sorted({r[0] for r in refs if not r[1]})
    pick = F.when(F.col("lang").isin(named), F.concat(F.lit("="), "lang")).otherwise(F.lit(ALL)) if named else F.lit(ALL)
    # places of the common words in the list, sorted: runs are counts; all other words are place 0
    slot = "CAST(shiftrightunsigned(x, shift) & (size(keys) - 1) AS int)"

    def held(part: DataFrame) -> DataFrame:
        # at most MAX_LANGS + 1 rows of a few hundred values
        return part.withColumn("ref", pick).join(F.broadcast(table), "ref").withColumn("places", F.expr(
            f"sort_array(transform(filter(hw, x -> get(keys, {slot}) = x), x -> get(key_places, {slot})))")).drop(
                "ref", "keys", "key_places", "shift", "lang")

    if rest is None:
        rows = held(rows)
    else:
        # A language outside the largest: salted by the text, and met by as many copies of its reference. One
        # without any word has no reference; its documents fail the base rule and take that of the whole table.
        small = F.col("lang").isNotNull() & ~F.col("lang").isin(named)
        salted = rows.where(small).withColumn("salt", F.pmod(F.xxhash64("hw"), F.lit(SALTS)).cast("int"))
        salts = rest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.where("n_words > 0").join(salts.hint("merge"), ["lang", "salt"]).withColumn("places", F.expr(
            "sort_array(filter(transform(hw, x -> CAST(array_position(keys, x) AS int)), x -> x > 0))")).drop(
                "lang", "salt", "keys")
        rows = met.unionByName(held(rows.where(~small | (F.col("n_words") == 0))).select(met.columns))
    rows = _repeats(rows).drop("hw").withColumn("n_symbols", F.get("classes", F.lit(4)))
    total = "aggregate(classes, 0L, (a, x) -> a + x)"
    rows = rows.withColumn("p_class", F.expr(f"transform(classes, x -> CAST(x AS double) / greatest(1L, {total}))"))
    rows = rows.withColumn("char_js", F.expr(
        f"""sqrt(greatest(0D, aggregate(sequence(0, {CLASSES - 1}), 0D, (a, k) -> a + {
            _js_term('get(p_class, k)', 'get(q_class, k)')})))"""))
    rows = rows.withColumn("ends", F.expr("""CASE WHEN size(places) = 0 THEN CAST(array() AS array<int>) ELSE
        filter(sequence(0, size(places) - 1), i ->
            i + 1 = size(places) OR get(places, i) <> get(places, i + 1)) END"""))
    rows = rows.withColumn("runs", F.expr("""CASE WHEN n_words = 0 THEN CAST(array() AS array<struct<p: double, q: double>>)
        ELSE concat(array(named_struct('p', CAST(n_words - size(places) AS double) / n_words, 'q', get(q_word, 0))),
            transform(ends, (e, j) -> named_struct(
                'p', CAST(e - coalesce(get(ends, j - 1), -1) AS double) / n_words,
                'q', get(q_word, get(places, e))))) END"""))
    # a class that the document lacks adds half its share in the reference
    rows = rows.withColumn("word_js", F.expr(
        f"""sqrt(greatest(0D, aggregate(runs, 0D, (a, r) -> a + {_js_term('r.p', 'r.q')})
            + 0.5D * (1D - aggregate(runs, 0D, (a, r) -> a + r.q))))"""))
    # The counter keeps a caller's filter above this step: pushed below it, each column would
    # be replaced by its whole expression, over and over.
    rows = rows.withColumn("above", F.monotonically_increasing_id() >= 0)
    failed = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"
    far = f"""(n_chars >= {MIN_CHARS} AND char_js > {MAX_CHAR_JS}) OR (n_words >= {MIN_WORDS}
        AND word_js > {MAX_WORD_JS} + {WORD_NOISE} / sqrt(CAST(greatest(1L, n_words) AS double)))"""
    return rows.withColumn("failed", F.expr(failed)).select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_js", "word_js",
        (F.col("above") & F.col("failed")).alias("base_failed"),
        (F.col("above") & ~F.col("failed") & ~F.expr(far)).alias("kept"))


def rate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept``, ``char_js``, ``word_js``; see ``rated``."""
    return rated(docs, text_col, lang_col, carry=[id_col]).select(
        F.col(f"row.{id_col}").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "char_js", "word_js")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The kept rows of ``docs``, all columns."""
    return rated(docs, text_col, lang_col).where("kept").select("row.*")
