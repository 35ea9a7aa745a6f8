"""A corpus pipeline: quality filter, exact and near dedup, mixing by source, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; `run` writes the rows of each
stage to the shared folder and reads them again. All but the last return the columns they were given. The mixture is the order in
which its rows are stored. A reader of several files is free to take them in any order, so the last stage returns each row's place there as
a column.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.llm import bpe, exact_dedup, jaccard_join, mixing, quality
from courtside.llm.plaintext import tokenizer_file
from courtside.llm.tables import columns_of, staged, table


#: The labelled rows that the quality filter learns from; their ids are broadcast, 400 KB at most.
FIT_ROWS = 50_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from at most FIT_ROWS labelled rows of the training folds (smallest hashes of the id); rows that score below 0.5 go."""
    labels = quality.training_labels(table(spark, sf_dir, "labels"), "quality").where("y is not null")
    labels = staged(labels.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(FIT_ROWS), "labels")
    learned = docs.join(F.broadcast(labels.select("doc_id")), "doc_id", "left_semi")
    model = quality.fit(quality.measured(learned), labels)
    return quality.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the row with the smallest id stays."""
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a Jaccard similarity of 0.8 on five-word shingles, the one with the smallest id stays."""
    found = jaccard_join.jaccard_components(docs, words=5, percent=80)
    gone = staged(found.where("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(columns_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of a mixture with weights by the square root of the sources' sizes."""
    return mixing.mixed(docs)


def stored_places(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns and `place`, a row's number in the order in which docs is stored: part files by their number, then rows.

    Only addresses are counted, and the files' counts are joined to the rows; the rows don't move. A reader may take the files
    in any order. Rows that are not all the rows of their Parquet files are written first.
    """
    address = [F.col("_metadata.file_name").alias("at_file"), F.col("_metadata.row_index").alias("at_row")]
    try:
        rows = docs.select(*columns, *address)
        files = _files(rows)
        whole = files.where("rows <> last + 1").isEmpty()
    except AnalysisException:
        whole = False
    if not whole:
        rows = staged(docs.select(*columns), "stored").select(*columns, *address)
        files = _files(rows)
    number = F.regexp_extract("at_file", r"^part-(\d+)", 1).try_cast("long")
    before = F.sum("rows").over(Window.orderBy(number, "at_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = staged(files.select("at_file", F.coalesce(before, F.lit(0)).alias("start")), "files")
    return rows.join(F.broadcast(starts), "at_file").select(*columns, (F.col("start") + F.col("at_row")).alias("place"))


def _files(rows: DataFrame) -> DataFrame:
    """A row per file: its rows and the last one's index."""
    return rows.groupBy("at_file").agg(F.count("*").alias("rows"), F.max("at_row").alias("last"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, the digest of the text that the ids decode to, and the row's place in the mixture as it was stored."""
    placed = stored_places(docs, "doc_id", "text")
    rows = bpe.encoded(placed, tokenizer_file("word_bpe_49k.json"), place_col="place")
    ids = F.when(F.col("n_tokens") > 0, F.split("ids", " ").cast("array<int>")).otherwise(F.array().cast("array<int>"))
    return rows.select("doc_id", "n_tokens", ids.alias("ids"), F.sha2("decoded", 256).alias("decoded_sha256"), "place")


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL expresses neither the classifier nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
