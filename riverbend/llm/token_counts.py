"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are additive: a change of a document is a
signed row, an insert ``+1``, a delete ``-1``, a revised count the delete of the old and the
insert of the new. A batch of changes is summed per key and written as one small table of
deltas in the rollup's folder, under the batch's name; it is committed by a marker file written
last. A batch whose marker is there has been committed and is left
alone, so a batch may be sent again after any failure; one without marker is overwritten.
Totals are the sums over committed batches; ``compact`` folds them into one, which the
readers see with the same totals.

The rows that a commit moves are the partial sums, one for each key and task: a hot source
costs no more than any other.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.llm.common import literal_table
from riverbend.session import checkpoint_path

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_bytes")
NAME = re.compile(r"[\w.-]+", re.ASCII)
DONE = "_done"  # beside the files of a finished table
SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_bytes bigint"


class Rollup:
    """Totals kept in ``path``, a folder that all executors share.

    Commits go to the folder of the newest generation. Compaction opens the next one, with a
    table of the totals so far and one of the names folded into it, so that a commit lists
    only the batches since, and looks a name up in a table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _finish(self, name: str) -> None:
        """Mark a table as whole, by a file of our own: sessions may switch Spark's markers off."""
        self._fs().create(self._path(f"{name}/{DONE}"), True).close()

    def _finished(self, pattern: str) -> list[str]:
        """Paths below ``path`` of the finished tables."""
        found = self._fs().globStatus(self._path(f"{pattern}/{DONE}")) or []
        return sorted("/".join(s.getPath().toString().split("/")[-3:-1]) for s in found)

    def generation(self) -> int:
        return max([0, *(int(t.split("/")[0].removeprefix("gen=")) for t in self._finished("gen=*/compact"))])

    def batches(self) -> list[str]:
        """Names of the batches committed since the last compaction."""
        tables = self._finished(f"gen={self.generation()}/batch=*")
        return [t.split("/")[1].removeprefix("batch=") for t in tables]

    def names(self, generation: int) -> DataFrame:
        """The names of all batches that a generation's compacted table holds."""
        return self.spark.read.schema("name string").parquet(f"{self.path}/gen={generation}/names")

    def committed(self, batch: str) -> bool:
        g = self.generation()
        if self._fs().exists(self._path(f"gen={g}/batch={batch}/{DONE}")):
            return True
        return g > 0 and not self.names(g).where(F.col("name") == batch).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (``source, lang, tokenizer, sign, n_tokens, n_bytes``) once under
        the name ``batch``. False: it was committed before, and nothing is done. Null counts
        add nothing; a null source or language is a key of its own; other columns are ignored."""
        if not batch or not NAME.fullmatch(batch) or batch.startswith("compact-"):
            raise ValueError("a batch needs a name of letters, digits and -_. that does not begin with compact-")
        if self.committed(batch):
            return False
        signed = lambda c: F.sum(F.col("sign") * F.coalesce(F.col(c).cast("long"), F.lit(0))).cast("long")
        deltas = changes.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), signed("n_tokens").alias("n_tokens"),
                                            signed("n_bytes").alias("n_bytes"))
        table = f"gen={self.generation()}/batch={batch}"
        deltas.write.mode("overwrite").parquet(f"{self.path}/{table}")
        self._finish(table)
        return True

    def live(self) -> list[str]:
        """The newest compacted table, if any, and the batches since."""
        g = self.generation()
        return [*([f"gen={g}/compact"] if g else []), *(f"gen={g}/batch={b}" for b in self.batches())]

    def _sums(self, tables: list[str]) -> DataFrame:
        if not tables:
            return self.spark.createDataFrame([], SCHEMA)
        deltas = self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{t}" for t in tables])
        return deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens, n_bytes``; keys whose documents are all
        gone are left out."""
        return self._sums(self.live()).where("n_docs <> 0 OR n_tokens <> 0 OR n_bytes <> 0")

    def compact(self) -> None:
        """Fold the committed batches into one table. Until the table's marker is there, readers and
        commits go on with the old generation. One writer at a time."""
        g, since = self.generation(), self.batches()
        if not since:
            return
        names = literal_table(self.spark, [(b,) for b in since], "name string")
        if g:
            names = names.unionByName(self.names(g))
        names.write.mode("overwrite").parquet(f"{self.path}/gen={g + 1}/names")
        self._sums(self.live()).write.mode("overwrite").parquet(f"{self.path}/gen={g + 1}/compact")
        self._finish(f"gen={g + 1}/compact")


def rollup(spark: SparkSession, name: str) -> Rollup:
    """A rollup in the shared folder that ``spark.checkpoint.dir`` names."""
    return Rollup(spark, checkpoint_path(spark, f"riverbend-llm/rollups/{name}"))


def inserts(counted: DataFrame, tokenizer: str, tokens_col: str = "n_tokens", bytes_col: str = "n_bytes",
            source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Change rows that insert each counted document."""
    return counted.select(
        F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"), F.lit(1).alias("sign"),
        F.col(tokens_col).cast("long").alias("n_tokens"), F.col(bytes_col).cast("long").alias("n_bytes"))


def deletes(counted: DataFrame, tokenizer: str, tokens_col: str = "n_tokens", **cols: str) -> DataFrame:
    """Change rows that take each counted document back."""
    return inserts(counted, tokenizer, tokens_col, **cols).withColumn("sign", F.lit(-1))


def revisions(counted: DataFrame, tokenizer: str, old_col: str, new_col: str, **cols: str) -> DataFrame:
    """Change rows that replace the count ``old_col`` of each document by ``new_col``."""
    return deletes(counted, tokenizer, old_col, **cols).unionByName(inserts(counted, tokenizer, new_col, **cols))
