"""Problem 4: one consistent form for text that looks the same.

Every Arrow partition goes through an embedded DuckDB, whose SQL maps full-width,
half-width and mathematical forms, blanks, hyphens, ligatures and invisible
characters (``translate``, ``replace``), brings look-alike letters of a word to
one script (``regexp_extract_all``, ``translate``) and composes accents
(``nfc_normalize``).  Line breaks, case, accents and digits stay as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import BLANKS, HYPHENS, INVISIBLE, LIGATURES, LOOKALIKE_FROM, LOOKALIKE_TO, spread, staged, table


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _forms() -> dict[str, str]:
    """Wide, narrow and mathematical forms of a character -> the character, by their decompositions."""
    out = {}
    for cp in [*range(0xFF00, 0xFFEF), 0x3000, *range(0x1D400, 0x1D800), *range(0x2100, 0x2150)]:
        tag, _, to = unicodedata.decomposition(chr(cp)).partition(" ")
        if tag in ("<wide>", "<narrow>", "<font>") and " " not in to and chr(cp) not in HYPHENS:
            out[chr(cp)] = chr(int(to, 16))
    return out | {"\uff9e": "\u3099", "\uff9f": "\u309a"}  # voicing marks join the sign before


def _scripts() -> list[tuple[str, str, str]]:
    """(letters that no Latin one looks like, Latin letters, their look-alikes) of Cyrillic and Greek."""
    out = []
    for lo, hi in ((0x400, 0x500), (0x370, 0x400)):
        pairs = {b: a for a, b in zip(LOOKALIKE_FROM, LOOKALIKE_TO, strict=True) if lo <= ord(a) < hi}
        strong = "".join(chr(c) for c in range(lo, hi) if unicodedata.category(chr(c))[0] == "L" and chr(c) not in LOOKALIKE_FROM)
        out.append((strong, "".join(pairs), "".join(pairs.values())))
    return out


def canonical_sql(column: str) -> str:
    """The DuckDB expression for the canonical form of ``column``."""
    pairs = _forms() | dict.fromkeys(BLANKS, " ") | dict.fromkeys(HYPHENS, "-")
    # what a translated text lacks in its "to" is deleted
    out = f"translate({column}, {_quoted(''.join(pairs) + INVISIBLE)}, {_quoted(''.join(pairs.values()))})"
    for lig, plain in LIGATURES.items():
        out = f"replace({out}, {_quoted(lig)}, {_quoted(plain)})"
    # a word with a letter of its own script is of that script; any other is Latin
    cases = "".join(f"WHEN regexp_matches(w, '[{strong}]') THEN translate(w, {_quoted(latin)}, {_quoted(alike)}) " for strong, latin, alike in _scripts())
    word = f"CASE {cases}ELSE translate(w, {_quoted(LOOKALIKE_FROM)}, {_quoted(LOOKALIKE_TO)}) END"
    parts = f"list_transform(regexp_extract_all({out}, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+'), lambda w: CASE WHEN regexp_matches(w, '[\u0370-\u04ff]') THEN {word} ELSE w END)"
    # plain ASCII is its own canonical form; few texts have letters that look like others
    return (
        f"CASE WHEN regexp_full_match({column}, '[\\x00-\\x7F]*') THEN {column} "
        f"WHEN regexp_matches({column}, '[\u0370-\u04ff]') THEN nfc_normalize(array_to_string({parts}, '')) ELSE nfc_normalize({out}) END"
    )


def canonical(df: DataFrame, id_col: str = "extraction_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """``id_col`` and ``text_col`` in canonical form.

    With ``digests``: instead of the text ``look`` (MD5 of the canonical form)
    and ``exact`` (MD5 of the text as it came), of texts that are not empty.
    Null stays null, empty stays empty, repeated rows stay repeated, other
    columns are ignored.
    """
    form = canonical_sql("text")
    if digests:
        sql, schema = f"SELECT id, md5({form}) AS look, md5(text) AS exact FROM batch WHERE text <> ''", "id bigint, look string, exact string"
    else:
        sql, schema = f"SELECT id, {form} AS text FROM batch", "id bigint, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        con.execute("SET preserve_insertion_order = true")
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                con.register("batch", pa.Table.from_batches([batch.slice(lo, 2000)]))
                out = con.sql(sql).to_arrow_table()
                yield from out.combine_chunks().to_batches()
        con.close()

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = spread(src.where("text <> ''") if digests else src).mapInArrow(run, schema)
    return out.withColumnsRenamed({"id": id_col} | ({} if digests else {"text": text_col}))


def look_classes(df: DataFrame, id_col: str = "extraction_id", text_col: str = "text") -> DataFrame:
    """One row per row with a text: ``look`` (class), ``exact`` (variant), class size, variants in the class."""
    d = canonical(df, id_col, text_col, digests=True)
    per = d.groupBy("look", "exact").agg(F.count("*").alias("n")).groupBy("look").agg(F.sum("n").alias("class_rows"), F.count("*").alias("variants"))
    return d.join(per, "look")


def look_pairs(df: DataFrame, id_col: str = "extraction_id", text_col: str = "text") -> DataFrame:
    """Pairs of rows that look the same and differ in their characters, smaller id first.

    Classes with one variant (exact copies of one text, however many) are
    dropped before anything is paired; copies pair only with other variants.
    Rows without id or text pair with nothing; a repeated id pairs once.
    """
    d = canonical(df, id_col, text_col, digests=True).where(F.col(id_col).isNotNull()).distinct()
    pair = d.groupBy("look", "exact").agg(F.lit(1)).groupBy("look").count().where("count > 1").select("look")
    d = staged(d.join(pair, "look"), "looks")
    variants = d.select("look", "exact").distinct()
    links = variants.alias("a").join(variants.alias("b"), "look").where("a.exact < b.exact").select(F.col("a.look").alias("look"), F.col("a.exact").alias("x"), F.col("b.exact").alias("y"))
    left = d.select(F.col(id_col).alias("i"), F.col("exact").alias("x"), "look")
    right = d.select(F.col(id_col).alias("j"), F.col("exact").alias("y"), "look")
    out = links.join(left, ["look", "x"]).join(right, ["look", "y"]).where("i <> j")
    return out.select(F.least("i", "j").alias(f"{id_col}_a"), F.greatest("i", "j").alias(f"{id_col}_b")).distinct()


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, variant and class sizes of each extraction with a text: what ``p4_found`` holds, without its pairs."""
    return look_classes(table(spark, sf_dir, "pages"))


def p4_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(table(spark, sf_dir, "pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_pairs(table(spark, sf_dir, "pages"))
