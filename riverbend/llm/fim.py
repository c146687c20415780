"""Fill-in-the-middle transformation by in-place block rotation.

Two cuts, drawn from a hash of the row's id, part a text into prefix, middle and suffix. The
text's bytes go into a bytearray and the sentinels are inserted where the blocks begin, which
gives ``<P>prefix<M>middle<S>suffix``. One exchange of neighbouring blocks then makes either
form, each by three reversals in place:

* psm, ``<P>prefix<S>suffix<M>middle``: the last two blocks change places;
* spm, ``<S>suffix<P>prefix<M>middle``: the last block changes places with the first two.

``restore`` finds the sentinels, exchanges the same blocks back and takes the sentinels out.
Draws and forms are SQL functions; the bytes are moved in Arrow batches, one text at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN, PSM, SPM = "plain", "psm", "spm"
STEP = 1 << 16  # bytes moved at once by a reversal, and scanned at once for a cut
BATCH_BYTES = 8 << 20  # of one Arrow batch handed back, one text at least
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point


class Sentinels(NamedTuple):
    """The markers of prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def checked(self) -> Sentinels:
        """The markers, if no text between them can make up another occurrence of one."""
        if not all(self):
            raise ValueError("a sentinel is empty")
        for a, b in permutations(self, 2):
            if a in b:
                raise ValueError(f"sentinel {b!r} contains {a!r}")
        if any(a[-k:] == b[:k] for a in self for b in self for k in range(1, min(len(a), len(b)))):
            raise ValueError("the end of a sentinel begins a sentinel")
        return self

    def raw(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def reverse(buf: bytearray, low: int, high: int) -> None:
    """Reverse ``buf[low:high]`` in place, mirrored pieces of at most ``STEP`` bytes at once."""
    while high - low > 1:
        k = min(STEP, (high - low) // 2)
        head = buf[low:low + k]
        head.reverse()
        tail = buf[high - k:high]
        tail.reverse()
        buf[low:low + k], buf[high - k:high] = tail, head
        low, high = low + k, high - k


def exchange(buf: bytearray, low: int, middle: int, high: int) -> None:
    """Exchange the neighbouring blocks ``[low, middle)`` and ``[middle, high)`` in place."""
    reverse(buf, low, middle)
    reverse(buf, middle, high)
    reverse(buf, low, high)


def offset(text: bytes, units: int) -> int:
    """Where the first ``units`` code points of UTF-8 ``text`` end, in bytes."""
    at = 0
    while at < len(text):
        piece = text[at:at + STEP]
        starts = len(piece.translate(None, CONTINUATION))
        if starts > units:  # the byte that starts one code point more is in this piece
            low, high = 0, len(piece)  # starts in piece[:low] <= units < starts in piece[:high]
            while high - low > 1:
                mid = (low + high) // 2
                if len(piece[:mid].translate(None, CONTINUATION)) <= units:
                    low = mid
                else:
                    high = mid
            return at + low
        units, at = units - starts, at + len(piece)
    return len(text)


def assemble(text: bytes, form: str, prefix: int, middle: int, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The output of a text cut after ``prefix`` and after ``middle`` more code points."""
    if form == PLAIN:
        return text
    p, s, m = marks
    first = offset(text, prefix)
    second = first + offset(text[first:], middle)
    buf = bytearray(text)
    for at, mark in ((second, s), (first, m), (0, p)):
        buf[at:at] = mark
    first, second = first + len(p), second + len(p) + len(m)
    exchange(buf, first if form == PSM else 0, second, len(buf))
    return bytes(buf)


def disassemble(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text that ``assemble`` was given."""
    if form == PLAIN:
        return output
    p, s, m = marks
    buf = bytearray(output)
    if form == PSM:
        exchange(buf, buf.index(s), buf.index(m), len(buf))
    else:
        exchange(buf, 0, buf.index(p), len(buf))
    for mark in (s, m, p):  # from the end
        at = buf.index(mark)
        del buf[at:at + len(mark)]
    return bytes(buf)


def _draw(key: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits of the key's SHA-256, as a number."""
    return F.conv(F.substring(F.sha2(key, 256), 8 * k - 7, 8), 16, 10).cast("bigint")


def _mapped(rows: DataFrame, last: str, work: Callable[..., bytes], inputs: int) -> DataFrame:
    """``rows`` with its last ``inputs`` columns, of which the first is the bytes, handed to
    ``work``, and their place taken by its result as the string column ``last``."""
    kept = len(rows.columns) - inputs
    names = [*rows.columns[:kept], last]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made, size, at = [], 0, 0
            for i in range(b.num_rows):
                made.append(work(*(b.column(k)[i].as_py() for k in range(kept, kept + inputs))))
                size += len(made[-1])
                if size >= BATCH_BYTES or i + 1 == b.num_rows:
                    columns = [c.slice(at, len(made)) for c in b.columns[:kept]]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())], names)
                    made, size, at = [], 0, i + 1

    return rows.mapInArrow(run, f"{kinds}, `{last}` binary").withColumn(last, F.col(last).cast("string"))


def transform(docs: DataFrame, seed: str = "1", rate: int = 90, spm_rate: int = 20,
              sentinels: Sentinels = Sentinels(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``doc_id, n, form, prefix_chars, middle_chars, output`` for every row.

    ``n`` counts the text's code points. The draws are four numbers of the SHA-256 of
    ``seed:id``: two cuts in 0 to n, then whether the row is transformed (``rate`` per cent)
    and as spm (``spm_rate`` per cent of those). A text that is null (taken as empty), empty or
    holds a sentinel stays plain, with null cuts. Rows without id draw as if it were written as
    nothing; rows of equal id cut alike, repeated rows come back as often as they came. Only
    the two named columns are read; an empty table gives no rows.
    """
    marks = sentinels.checked().raw()
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.length(text).cast("bigint")
    has_mark = F.lit(False)
    for mark in sentinels:
        has_mark = has_mark | F.contains(text, F.lit(mark))
    form = (F.when((n == 0) | has_mark | (_draw(key, 3) % 100 >= rate), PLAIN)
            .when(_draw(key, 4) % 100 < spm_rate, SPM).otherwise(PSM))
    cuts = F.array(_draw(key, 1) % (n + 1), _draw(key, 2) % (n + 1))
    cut = lambda c: F.when(F.col("form") != PLAIN, c)
    drawn = docs.select(F.col(id_col).alias("doc_id"), n.alias("n"), form.alias("form"),
                        F.array_min(cuts).alias("low"), F.array_max(cuts).alias("high"),
                        text.cast("binary").alias("text"))
    rows = drawn.select("doc_id", "n", "form", cut(F.col("low")).alias("prefix_chars"),
                        cut(F.col("high") - F.col("low")).alias("middle_chars"),
                        "text", F.col("form").alias("f"), F.coalesce("low", F.lit(0)).alias("p"),
                        F.coalesce(F.col("high") - F.col("low"), F.lit(0)).alias("m"))
    return _mapped(rows, "output", lambda t, f, p, m: assemble(t, f, p, m, marks), 4)


def restore(made: DataFrame, sentinels: Sentinels = Sentinels()) -> DataFrame:
    """``made`` (``transform``'s rows, with or without columns of its own) and ``restored``,
    the text rebuilt from ``output`` and ``form`` alone. A null output restores to empty."""
    marks = sentinels.checked().raw()
    rows = made.select("*", F.coalesce(F.col("output").cast("binary"), F.lit(b"")).alias("_o"), F.col("form").alias("_f"))
    return _mapped(rows, "restored", lambda o, f: disassemble(o, f, marks), 2)
