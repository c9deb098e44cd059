"""A training corpus from raw documents: five stages, each one operator of ``edgeworks.llm``.

Every stage takes the table its predecessor has left, judges every row of it,
and returns what stays with all columns of documents; the last returns tokens.

1. language ID: documents without a letter, or whose best language has a
   calibrated probability below ``MIN_SCORE``, go.
2. line dedup: lines on more than a twentieth of their source's different texts
   go (copies have one vote together: removing them is the next stage's work); a
   document that loses none keeps its text as it is, ``n_chars`` follows.
3. MinHash near-dedup: of each group of documents linked by a likeness of 0.8
   of their five-word shingles, the one with the smallest doc_id stays.
4. decontamination: documents that hold a ten-word window of the benchmark go.
5. byte-level BPE: ``(doc_id, n_tokens, ids, decoded_sha256)``.

Null or empty text: goes with the first stage. A document of which line dedup
leaves nothing stays, with an empty text. Rows are told apart by their id and
text together: of those that repeat both one stays, different texts under one
id are judged each on its own. Null ids: such rows are told apart by their texts
alone. Extra columns are kept as they are, whatever their names. An empty table
passes as such.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.llm import bpe, decontaminate, language, lines, minhash
from edgeworks.llm.common import table
from edgeworks.llm.shipping import ship
from edgeworks.loop import Workspace

MIN_SCORE = 0.5
WORDS, PERCENT = 5, 80
#: Half of op8's ratio, which lies on the rate of the corpus' own boilerplate: at sf0.1 one line stands on
#: 43 to 66 of each source's 500 documents (8.6 to 13.2%), over a tenth in 11 of 20 sources only.
LINE_RATIO = 0.05
# Different texts that must share a line: in a small source two near copies alone are over the ratio.
LINE_VOTES = 5


def _packed(docs: DataFrame) -> DataFrame:
    """The id and text of each document beside the whole row, where no name can clash."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = language.train(docs.select("doc_id", "text", "lang"))
    found = language.identify(_packed(docs), model)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _packed(docs).select("row", F.col("row.source").alias("site"), lines.text_lines(F.col("text")).alias("lines"))
    done = lines.drop_boilerplate(rows, ratio=LINE_RATIO, min_pages=LINE_VOTES, by_text=True)
    changed = F.size("kept") < F.size("lines")
    text = F.when(changed, F.array_join("kept", "\n")).otherwise(F.col("row.text"))
    done = done.select("row", "kept", text.alias("text"), changed.alias("changed"))
    names = {"text": F.col("text"), "n_chars": F.when(F.col("changed"), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))}
    return done.select(*[names.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _key(docs: DataFrame) -> Column:
    """What tells a row from all others that differ in id or text; smallest for the smallest id, null ids last."""
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest")
    return F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), digest)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = _packed(docs).select(_key(docs).alias("key"), "text", "row")
    found = minhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"), words=WORDS, percent=PERCENT)
    marks = found.groupBy(F.col("doc_id").alias("of")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    stay = rows.select("key", "row").join(marks.filter("kept"), F.col("key") == F.col("of")).select("key", "row", "n")
    return stay.filter("n = 1").unionByName(stay.filter("n > 1").dropDuplicates(["key"])).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_packed(docs), table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.tokenized(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", without_boilerplate),
    ("minhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("bpe", tokens),
]

#: Neither a trained classifier nor BPE can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage leaves is written and read again by the next."""
    work, docs = Workspace(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
