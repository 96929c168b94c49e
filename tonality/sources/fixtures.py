"""Views that let the driver's tables play the reference's inputs.

* ``reviews``      – labelled corpus (documents joined with labels, split by a fixed rule)
* ``messages``     – the 27-column e-mail table, filled from ``conversations``
* ``tokens``       – every normalised token of every document, with its piece position
* ``word_vectors`` – word -> vector: the n-th most frequent word gets embedding ``vec_id = n``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import LABEL_NAMES, normalised_pieces
from ..plans.broadcast import bounded_broadcast
from ..plans.partitioning import spread
from ..plans.ranking import global_ordinal, top_by_count_candidates
from ..session import scratch_root
from .tables import read_table, row_count, table_path

# Fixed rule of the fixture: every fifth document id is held out for testing.
TEST_MODULUS = 5
# Per-row bound for a (bigint, int, int) broadcast hash relation, generous.
LABEL_ROW_BYTES = 64
# Categorical domain of the message role, in code order.
ROLE_DOMAIN = ("system", "user", "assistant")

# The e-mail table's declared columns, in file order, with their types.
EMAIL_COLUMNS = (
    ("Id", "double"), ("DocNumber", "string"), ("MetadataSubject", "string"),
    ("MetadataTo", "string"), ("MetadataFrom", "string"), ("MetadataDateSent", "timestamp"),
    ("MetadataDateReleased", "timestamp"), ("MetadataPdfLink", "string"),
    ("MetadataCaseNumber", "string"), ("MetadataDocumentClass", "string"),
    ("ExtractedSubject", "string"), ("ExtractedTo", "string"), ("ExtractedFrom", "string"),
    ("ExtractedCc", "string"), ("ExtractedDateSent", "timestamp"),
    ("ExtractedCaseNumber", "string"), ("ExtractedDocNumber", "string"),
    ("ExtractedDateReleased", "timestamp"), ("ExtractedReleaseInPartOrFull", "string"),
    ("ExtractedBodyText", "string"), ("RawText", "string"), ("SenderPersonId", "double"),
    ("SenderName", "string"), ("SenderAlias", "string"), ("RecipientPersonId", "double"),
    ("RecipientName", "string"), ("RecipientAlias", "string"),
)


_TYPES = {"double": T.DoubleType(), "string": T.StringType(), "timestamp": T.TimestampType()}


def email_schema(all_strings: bool = False) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType() if all_strings else _TYPES[t], True)
                         for n, t in EMAIL_COLUMNS])


def split_of(doc_id) -> F.Column:
    return F.when(F.pmod(doc_id, F.lit(TEST_MODULUS)) == 0, F.lit("test")).otherwise(F.lit("train"))


def documents(spark: SparkSession, sf_dir: str, cols=("doc_id", "text")) -> DataFrame:
    """The documents table, spread on doc_id when its scan is narrower than the cluster."""
    scan = read_table(spark, sf_dir, "documents")
    return spread(scan, "doc_id", table_path(sf_dir, "documents")).select(*cols)


def reviews(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """doc_id, text, split, sentiment, label (0 = positive, 1 = negative)."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    labels = bounded_broadcast(labels, row_count(spark, sf_dir, "labels") * LABEL_ROW_BYTES)
    cols = ["doc_id", "text"] if with_text else ["doc_id"]
    docs = documents(spark, sf_dir, cols) if with_text else read_table(spark, sf_dir, "documents")
    return (docs.select(*cols).join(labels, "doc_id")
            .select(*cols,
                    split_of(F.col("doc_id")).alias("split"),
                    F.when(F.col("quality") == 1, F.lit(LABEL_NAMES[0]))
                    .otherwise(F.lit(LABEL_NAMES[1])).alias("sentiment"),
                    F.when(F.col("quality") == 1, F.lit(0)).otherwise(F.lit(1)).alias("label")))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 27-column e-mail table: role is subject and release category, text is body,
    conv_id and turn fill the numeric id columns that the transform drops."""
    conv = read_table(spark, sf_dir, "conversations")
    filled = {
        "Id": F.col("conv_id").cast("double"),
        "MetadataSubject": F.col("role"),
        "ExtractedReleaseInPartOrFull": F.col("role"),
        "ExtractedBodyText": F.col("text"),
        "SenderPersonId": F.col("turn").cast("double"),
    }
    return conv.select(*[
        (filled[n] if n in filled else F.lit(None).cast(t)).alias(n) for n, t in EMAIL_COLUMNS])


def tokens_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, word): one row per non-empty normalised token; ``pos`` numbers the
    white-space pieces from 0, so it orders tokens within a text."""
    return (df.select(id_col, F.posexplode(normalised_pieces(text_col)).alias("pos", "word"))
            .where(F.col("word") != "")
            .select(id_col, F.col("pos").cast("bigint").alias("pos"), "word"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_of(documents(spark, sf_dir))


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, n: occurrences over all documents (partial aggregation handles hot words)."""
    return (tokens(spark, sf_dir).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")))


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, vec_id, vector: the rank of a word by (count desc, word asc) is its vec_id.

    The rank comes from a distributed sort (``global_ordinal``), never a
    single-partition window, over only the words that can rank below the number of
    vectors (``top_by_count_candidates``); the embedding side joins on the rank.
    """
    n_vectors = row_count(spark, sf_dir, "embeddings")
    # The counts are read by the histogram and by each pass of the ordinal: written once, the
    # texts are tokenised once.
    scratch_root(spark)
    counts = word_counts(spark, sf_dir).checkpoint()
    # Only words that can rank below n_vectors are sorted (histogram threshold).
    candidates = top_by_count_candidates(counts, n_vectors)
    ranked = global_ordinal(candidates, ["n", "word"], out="rank", descending=["n"])
    emb = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"), F.col("embedding").alias("vector"))
    ranked = ranked.where(F.col("rank") < F.lit(n_vectors))
    return ranked.join(emb, ranked["rank"] == emb["vec_id"]).select("word", "vec_id", "vector")
