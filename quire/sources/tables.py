"""Table sources: the parquet tables, page checkpoints, and what a resumed run still has to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("book_id", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        *[T.StructField(n, T.StringType()) for n in ("text", "raw_text", "page_type")],
        *[T.StructField(n, T.BooleanType()) for n in ("has_footnotes", "has_illustrations", "has_indic_script", "has_tables", "has_poetry")],
        T.StructField("chapter_heading", T.StringType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("fidelity", T.DoubleType()),
        *[T.StructField(n, T.StringType()) for n in ("extraction_model", "structure_data")],
        T.StructField("warnings", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
        T.StructField("success", T.BooleanType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest(pages: DataFrame) -> DataFrame:
    """The latest extraction of each page of each book.

    Ties fall to the larger extraction_id; pages without number are one page.
    A page has few extractions, so the window stays small for any book.
    """
    w = Window.partitionBy("book_id", "page_number").orderBy(F.col("extracted_at").desc_nulls_last(), F.col("extraction_id").desc())
    return pages.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def page_range(pages: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Pages of an inclusive range; pushed down to the scan."""
    if first is not None:
        pages = pages.where(F.col("page_number") >= first)
    return pages if last is None else pages.where(F.col("page_number") <= last)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Cached page rows of JSON files; a corrupt record is a miss, not an error."""
    df = spark.read.schema(T.StructType([*PAGE_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return df.where("_corrupt is null and page_number is not null").drop("_corrupt")


def write_checkpoint(pages: DataFrame, path: str, cache_failures: bool = False, mode: str = "append") -> None:
    """Keep page rows as JSON by book; failures only when asked for."""
    kept = pages if cache_failures else pages.where("success")
    kept.select(*[f.name for f in PAGE_SCHEMA.fields]).write.mode(mode).partitionBy("book_id").json(path)


def pending(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """Wanted (book_id, page_number) that no successful cached page covers."""
    return wanted.join(cached.where("success").select("book_id", "page_number").distinct(), ["book_id", "page_number"], "left_anti")


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_book_text(lines: DataFrame, path: str) -> None:
    """One ordered text per book: ``book_id, value`` with the whole text in value."""
    lines.select("book_id", "value").write.mode("overwrite").partitionBy("book_id").text(path)


def q_latest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "pages")).select("extraction_id", "book_id", "page_number")


def q_pending_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages a resumed run still has to extract: 1..total_pages of each book, less the good ones."""
    books = table(spark, sf_dir, "books").where("total_pages > 0")
    wanted = books.select("book_id", F.explode(F.sequence(F.lit(1), F.col("total_pages"))).alias("page_number"))
    return pending(wanted, table(spark, sf_dir, "pages"))


def q_checkpoint_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per book: pages kept by a checkpoint without and with failures."""
    p = table(spark, sf_dir, "pages")
    return p.groupBy("book_id").agg(F.count_if(F.coalesce("success", F.lit(False))).alias("kept"), F.count("*").alias("kept_with_failures"), F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"))


QUERIES = {"latest_pages": q_latest_pages, "pending_pages": q_pending_pages, "checkpoint_keys": q_checkpoint_keys}
SQL = {
    "latest_pages": """SELECT extraction_id, book_id, page_number FROM (SELECT *, row_number() OVER (PARTITION BY book_id, page_number
        ORDER BY extracted_at DESC NULLS LAST, extraction_id DESC) AS rn FROM pages) WHERE rn = 1""",
    "pending_pages": """SELECT b.book_id, CAST(n AS INTEGER) AS page_number FROM (SELECT book_id, unnest(range(1, total_pages + 1)) AS n FROM books WHERE total_pages > 0) b
        WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.success AND p.book_id = b.book_id AND p.page_number = b.n)""",
    "checkpoint_keys": """SELECT book_id, count(*) FILTER (WHERE coalesce(success, false)) AS kept, count(*) AS kept_with_failures,
        min(page_number) AS first_page, max(page_number) AS last_page FROM pages GROUP BY book_id""",
}
