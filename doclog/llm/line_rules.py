"""Quality rules within a document, and lines that too many documents of a host repeat. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch

#: Words of a window that must not come twice.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: A document fails with fewer words, or with more than so many per cent of its words in repeated windows.
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: A line goes when more documents of its host hold it than the first and than one in so many of the host's, and a
#: document when its lines lose more than this share of its words or leave fewer than MIN_WORDS.
MAX_DOCUMENTS, ONE_IN, MAX_LOST_PERCENT = 30, 1000, 50
#: The sizes of large hosts are repeated so often, so that the lines of one host meet them in many tasks.
SALTS = 32


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def _measured(rows: DataFrame) -> DataFrame:
    """Base figures of `_text`. Windows are compared by a 64-bit hash of the words' hashes, within one document only."""
    hashes = F.transform(F.filter(F.split("_text", SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))
    rows = rows.withColumn("_words", hashes).withColumn("n_words", F.size("_words").cast("long"))
    window = ", ".join(["x", *(f"_words[i + {k}]" for k in range(1, WINDOW))])
    rows = rows.withColumn(
        "_windows",
        F.expr(
            f"IF(n_words < {WINDOW}, cast(array() AS array<bigint>), "
            f"transform(slice(_words, 1, cast(n_words AS int) - {WINDOW - 1}), (x, i) -> xxhash64({window})))"
        ),
    )
    # Sorted by hash, equal windows are neighbours; most documents have none and stop here.
    rows = rows.withColumn(
        "_sorted",
        F.expr(
            "IF(size(_windows) = size(array_distinct(_windows)), NULL, "
            "array_sort(transform(_windows, (x, i) -> struct(x AS x, i AS i))))"
        ),
    )
    rows = rows.withColumn(
        "_starts",
        F.expr(
            "array_sort(filter(transform(_sorted, (e, k) -> IF(k > 0 AND _sorted[greatest(k - 1, 0)].x = e.x "
            "OR k + 1 < size(_sorted) AND _sorted[least(k + 1, size(_sorted) - 1)].x = e.x, e.i, NULL)), "
            "v -> v IS NOT NULL))"
        ),
    )
    covered = F.expr(
        f"aggregate(transform(_starts, (v, k) -> IF(k + 1 < size(_starts), "
        f"least({WINDOW}, _starts[least(k + 1, size(_starts) - 1)] - v), {WINDOW})), 0L, (a, b) -> a + b)"
    )
    lines = _lines(F.col("_text"))
    rows = rows.withColumn("_raw", lines)
    text = F.col("_text")
    return rows.select(
        *(c for c in rows.columns if not c.startswith("_") and c != "n_words"),
        "_text",
        "_host",
        F.col("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_raw") - F.size(F.array_distinct("_raw"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.transform("_raw", _hashed).alias("_lines"),
    )


def _hashed(line: Column) -> Column:
    """Hash of the normalised line, and its words: the single spaces that are left, and one."""
    normal = _normal(line)
    words = F.length(normal) - F.length(F.translate(normal, " ", "")) + 1
    return F.struct(F.xxhash64(normal).alias("hash"), words.alias("words"))


def line_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    one_in: int = ONE_IN,
    max_lost_percent: int = MAX_LOST_PERCENT,
    with_text: bool = False,
) -> DataFrame:
    """A row per row of `docs`: `id_col`, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lost_words, kept, and with `with_text` clean_text, the text without the lines that go.

    A line is compared without regard to case and white space. It goes when more than `max_documents` documents of its
    host hold it, and more than one in `one_in` of the host's documents, so that a host that grows does not pass the
    limit by its size. Every row is a document: copies count each. A document is kept when the base rules pass and its
    lines that go hold no more than `max_lost_percent` of its words and leave MIN_WORDS.

    Texts are read once, into a narrow table of figures and line hashes. Each document brings a line once, counts are
    made per (host, line) with partial aggregation, so a line of any frequency leaves one row per task. Hosts of more
    than `max_documents * one_in` documents, for which the share decides, meet their frequent lines in salted groups.
    Lines above the limits are joined back, and lost words are added up per document.

    Null texts count as empty, null hosts as one host. Rows that repeat are documents and judged each; ids may be null.
    Other columns are ignored. An empty document has no words and fails the base rules.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.coalesce(F.col(host_col), F.lit("")).alias("_host"),
    )
    measured = _measured(rows.withColumnRenamed("_id", "row_id"))
    measured = measured if with_text else measured.drop("_text")
    figures = scratch.save(measured.withColumn("_uid", F.monotonically_increasing_id()))

    lines = figures.select("_uid", "_host", "n_words", F.inline("_lines"))
    often = (
        figures.select("_host", F.explode(F.array_distinct("_lines.hash")).alias("hash"))
        .groupBy("_host", "hash")
        .agg(F.count("*").alias("documents"))
        .where(F.col("documents") > max_documents)
        .withColumn("_salt", F.pmod("hash", F.lit(SALTS)).cast("int"))
    )
    large = (
        figures.groupBy("_host")
        .agg(F.count("*").alias("size"))
        .where(F.col("size") > max_documents * one_in)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    share = F.coalesce(F.col("documents") * one_in > F.col("size"), F.lit(True))
    frequent = often.join(large, ["_host", "_salt"], "left").where(share).select("_host", "hash")
    gone = lines.join(frequent, ["_host", "hash"])
    lost = gone.groupBy("_uid").agg(
        F.sum("words").cast("long").alias("lost"), *([F.collect_set("hash").alias("_gone")] if with_text else [])
    )
    judged = figures.join(lost, "_uid", "left")
    n, words = F.coalesce("lost", F.lit(0).cast("long")), F.col("n_words")
    failed = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * words)
    depleted = (n > 0) & ((100 * n > max_lost_percent * words) | (words - n < MIN_WORDS))
    out = [
        F.col("row_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        n.alias("n_lost_words"),
        (~failed & ~depleted).alias("kept"),
    ]
    if with_text:
        left = F.filter(
            F.split("_text", "\n"),
            lambda line: F.col("_gone").isNull() | ~F.array_contains("_gone", F.xxhash64(_normal(line))),
        )
        out.append(F.array_join(left, "\n").alias("clean_text"))
    return judged.select(*out)
