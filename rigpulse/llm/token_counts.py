"""Token counts by source, language and tokenizer version, kept as a delta-maintained rollup.

A change says that a document's count under a tokenizer version appears (insert), goes (delete) or
is replaced (revise). Changes are signed and summed to one small delta per batch before anything
is stored; totals are the sum of all committed deltas, so no document is ever counted again. A
batch is a folder named by its id and is overwritten as a whole: committing it twice, or again
after a crash, counts once. Folding merges old deltas into one and names the batches it contains,
whose later replays are then ignored.

Null source or language is a group of its own. A null or empty text has a count of zero and still
counts as a document. Repeated rows count each. A group whose documents have all gone disappears.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

# Tokenizer versions: a pattern whose matches are the tokens.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "words-2": r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]",
}


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens."""
    pattern = TOKENIZERS[tokenizer]
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"),
        F.regexp_count(text, F.lit(pattern)).cast("long").alias("n_tokens"),
    )


def _signed(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(
        *GROUP, F.lit(sign).cast("long").alias("n_docs"), (sign * F.col("n_tokens")).alias("n_tokens")
    )


def inserts(counts: DataFrame) -> DataFrame:
    return _signed(counts, 1)


def deletes(counts: DataFrame) -> DataFrame:
    return _signed(counts, -1)


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts go, the new ones come."""
    return deletes(old).unionByName(inserts(new))


def summed(changes: DataFrame) -> DataFrame:
    return (
        changes.groupBy(*GROUP)
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        .where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))
    )


class Rollup:
    """The committed deltas under one folder of a store that Spark can write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folders(self) -> list[str]:
        """Names of the committed folders; a folder without its success mark is none."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return [n for n in names if fs.exists(hadoop.Path(f"{self.root}/{n}/_SUCCESS"))]

    def _folded(self, folders: list[str]) -> tuple[str | None, set[str]]:
        """The newest folding (its number leads its name) and the batches it contains."""
        folds = sorted(n for n in folders if n.startswith("fold="))
        if not folds:
            return None, set()
        listed = self.spark.read.text(f"{self.root}/{folds[-1]}/batches").collect()
        return folds[-1], {json.loads(r[0]) for r in listed if r[0]}

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Store a batch's delta; a replay replaces it."""
        if not batch or "/" in batch:
            raise ValueError("a batch needs an id without slashes")
        if batch in self._folded(self._folders())[1]:
            return
        summed(changes).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def totals(self) -> DataFrame:
        folders = self._folders()
        fold, inside = self._folded(folders)
        paths = [
            f"{self.root}/{n}" for n in folders
            if n.startswith("batch=") and n.removeprefix("batch=") not in inside
        ]
        if fold:
            paths.append(f"{self.root}/{fold}/totals")
        if not paths:
            return self.spark.createDataFrame([], DELTA)
        # Read path by path, so that the folder names are no partition columns.
        deltas = self.spark.read.schema(DELTA).option("recursiveFileLookup", "true").parquet(*paths)
        return summed(deltas)

    def fold(self) -> None:
        """Merge all committed deltas; batches folded before stay named."""
        folders = self._folders()
        fold, inside = self._folded(folders)
        names = inside | {n.removeprefix("batch=") for n in folders if n.startswith("batch=")}
        number = int(fold.removeprefix("fold=")) + 1 if fold else 0
        at = f"{self.root}/fold={number:08d}"
        self.totals().write.mode("overwrite").parquet(f"{at}/totals")
        listed = self.spark.createDataFrame([(json.dumps(n),) for n in sorted(names)], "value string")
        listed.write.mode("overwrite").text(f"{at}/batches")
        # The mark comes last: before it, the folding does not count.
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{at}/_SUCCESS")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()


def later_copies(docs: DataFrame) -> DataFrame:
    """Ids of documents whose text a document with a smaller id has."""
    keyed = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("doc_id").alias("first"))
    return keyed.join(first, "digest").where(F.col("doc_id") != F.col("first")).select("doc_id")


def maintained(docs: DataFrame, root: str) -> DataFrame:
    """Totals after three batches, each a daily step of a corpus, one of them replayed.

    All documents are inserted under the first tokenizer version; later copies of a text are
    deleted; what remains is counted anew under the second version.
    """
    rollup = Rollup(docs.sparkSession, root)
    old = counted(docs, "words-1")
    copies = later_copies(docs)
    rollup.commit("load", inserts(old))
    rollup.commit("copies", deletes(old.join(copies, "doc_id", "left_semi")))
    rollup.fold()
    stay = docs.join(copies, "doc_id", "left_anti")
    change = revisions(counted(stay, "words-1"), counted(stay, "words-2"))
    rollup.commit("recount", change)
    rollup.commit("recount", change)
    return rollup.totals()


def whole(docs: DataFrame, root: str) -> DataFrame:
    """Totals of every document, copies too, under both tokenizer versions.

    All are inserted under the first version; an eighth of them goes and comes back, with a folding
    between and its return replayed; all are inserted under the second version.
    """
    rollup = Rollup(docs.sparkSession, root)
    old = counted(docs, "words-1")
    some = old.where(F.pmod(F.xxhash64("doc_id"), F.lit(8)) == 0)
    rollup.commit("load", inserts(old))
    rollup.commit("withdrawn", deletes(some))
    rollup.fold()
    rollup.commit("returned", inserts(some))
    rollup.commit("returned", inserts(some))
    rollup.commit("second", inserts(counted(docs, "words-2")))
    return rollup.totals()
