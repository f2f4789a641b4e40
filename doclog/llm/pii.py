"""Personal data: fixed forms, and identifiers that bootstrapped contexts discover."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

#: Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")

#: Rounds of scoring; different seeds that a pattern needs; the least confidence of a pattern and of an instance.
ROUNDS, MIN_SEEDS, CONFIDENT = 3, 5, 0.8
#: Characters to each side in which the words of a context are looked for, one after the other.
CONTEXT = 64
#: Characters that a run of digit groups has at most as one identifier; account numbers have up to 42.
RUN = 48
#: Discovered values that are sent to the tasks.
FEW = 50_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match never begins inside a run of digits, since it would have begun at the run's start; saying so keeps it linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: What may be an identifier: a word with a digit or an at sign.
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")
_SPACES = " \t\n\x0b\x0c\r"
_OPEN, _CLOSE = "\"'([<{", ",.;:!?)]>\"'}&|"
#: Groups of digits with single blanks between them, such as a phone or account number that is written in parts.
_RUN = re.compile(
    r"(?<![^\x20\x09-\x0D=:\"'(\[<{])[+(]{0,2}(?:[A-Z]{2})?"
    r"[0-9][0-9()/+-]*+(?: [(]?[0-9][0-9()/+-]*+(?![^\x20\x09-\x0D,.;:!?)\]>\"'}&|]))++"
)
#: A key glued to its value, at the start of a word or behind another field. Groups of an IP 6 address are none.
_FIELD = re.compile(
    r"(?:(?<![^\x20\x09-\x0D{(\[<,;&?|\"'])|(?<=[:=])(?=[A-Za-z0-9_.-]{1,40}[\"']?=))"
    r"(?![0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{0,4}:)([A-Za-z_][A-Za-z0-9_.-]{0,39})[\"']?([=:])"
)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, leftmost and without overlap in each kind, in order."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _word_before(text: str, at: int) -> tuple[str, int]:
    """The word that ends before `at`, or its last characters, and where it begins."""
    end, least = at, max(0, at - CONTEXT)
    while end > least and text[end - 1] in _SPACES:
        end -= 1
    start, least = end, max(0, end - CONTEXT)
    while start > least and text[start - 1] not in _SPACES:
        start -= 1
    return text[start:end], start


def _word_after(text: str, at: int) -> str:
    m = _TOKEN.search(text, at, at + CONTEXT)
    return m.group() if m else ""


def _plain(word: str) -> str:
    return re.sub("[0-9]+", "0", word.lower().strip(",.;:!?()[]\"'"))


def _make(value: str) -> str:
    """Kinds of characters of an instance."""
    kinds = {"9" if c.isdigit() else "a" if c.isalpha() else c for c in value}
    return "".join(sorted(kinds))


def _key(text: str, start: int) -> tuple[str, int]:
    """The key that the value at `start` is given to, with its sign, or "", and where the words before it end."""
    at, least = start, max(0, start - CONTEXT)
    while at > least and text[at - 1] in _OPEN:
        at -= 1
    for m in _FIELD.finditer(text, least, at):
        if m.end() == at:
            return m.group(1).lower() + m.group(2), m.start()
    one, before = _word_before(text, at)
    return (_plain(_word_before(text, before)[0]) + one if one in ("=", ":") else ""), at


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Contexts of an instance: the word before it, the two words, the word and the one behind, or the key it is given
    to."""
    key, key_at = _key(text, start)
    one, at = _word_before(text, key_at)
    two, _ = _word_before(text, at)
    one, two, behind = _plain(one), _plain(two), _plain(_word_after(text, end))
    found = [f"1 {one}", f"2 {two} {one}", f"3 {one} _ {behind}"] if one else []
    return found + ([f"k {key}"] if key else [])


def _values(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The word, or the values of the keys that are glued together in it, without quotes and signs around them."""
    cuts = [(m.start(), m.end()) for m in _FIELD.finditer(text, start, end)]
    for at, to in zip([start, *(e for _, e in cuts)], [*(s for s, _ in cuts), end]):
        while to > at and text[to - 1] in _CLOSE:
            to -= 1
        while at < to and text[at] in _OPEN and not (text[at] == "(" and text.find(")", at, min(to, at + RUN)) > 0):
            at += 1
        yield at, to


def instances(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int | None, str, list[str]]]:
    """(start, end, kind or None, value, patterns) of the fixed forms, and of the words and runs of digit groups that
    may be identifiers. A run and a word of it may both be."""
    for start, kind, end in base:
        yield start, end, kind, text[start:end], _patterns(text, start, end)
    if not _MARK.search(text):
        return
    at = covered = reach = 0  # covered: spans that begin before the end of the value at hand; reach: where they end
    for mark in _MARK.finditer(text):
        if mark.start() < at:
            continue
        first = mark.start()
        while first > at and text[first - 1] not in _SPACES:
            first -= 1
        at = _TOKEN.match(text, mark.start()).end()
        for start, end in _values(text, first, at):
            while covered < len(base) and base[covered][0] < end:
                reach = max(reach, base[covered][2])
                covered += 1
            value = text[start:end]
            if len(value) >= 6 and reach <= start and len(_MARK.findall(value)) > 1:
                yield start, end, None, value, _patterns(text, start, end)
    covered = reach = 0
    for m in _RUN.finditer(text):
        start, end = m.span()
        while not "0" <= text[end - 1] <= "9":
            end -= 1
        while covered < len(base) and base[covered][0] < end:
            reach = max(reach, base[covered][2])
            covered += 1
        if 6 <= end - start <= RUN and reach <= start:
            yield start, end, None, text[start:end], _patterns(text, start, end)


_SPAN = "struct<start:int,kind:int,end:int>"
_INSTANCE = "struct<start:int,end:int,kind:int,value:string,patterns:array<string>,make:string>"


def _scanned(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """`keep` columns with _base and _seen of each text."""
    schema = T.StructType(
        [
            *(docs.schema[c] for c in keep),
            *T._parse_datatype_string(f"_base array<{_SPAN}>, _seen array<{_INSTANCE}>").fields,
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                base, seen = [], []
                for text in batch.column("_scan").to_pylist():
                    spans = base_spans(text or "")
                    base.append([dict(start=s, kind=k, end=e) for s, k, e in spans])
                    names = ("start", "end", "kind", "value", "patterns", "make")
                    seen.append([dict(zip(names, (*i, _make(i[3])))) for i in instances(text or "", spans)])
                columns = [batch.column(c) for c in keep]
                columns += [pa.array(v, arrow.field(n).type) for n, v in (("_base", base), ("_seen", seen))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select(*keep, F.col(text_col).alias("_scan")).mapInArrow(run, schema)


def _discovered(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """(value, kind) of instances outside the fixed forms that confident patterns point to."""
    # Each context is a pattern, and so is each context with the kinds of characters of the instance.
    made = F.transform("i.patterns", lambda p: F.concat_ws(" ", p, "i.make"))
    seen = rows.select(F.explode("_seen").alias("i")).select(
        "i.kind", "i.value", F.explode(F.concat("i.patterns", made)).alias("pattern")
    )
    # A pattern and an instance are joined once, however often they meet.
    edges = scratch.save(seen.groupBy("pattern", "value").agg(F.min("kind").alias("kind")))
    totals = edges.groupBy("pattern").agg(F.count("*").alias("total"))
    seeds = edges.where("kind IS NOT NULL").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    known = scratch.save(seeds)
    found = known.where("false")
    for _ in range(ROUNDS):
        hits = edges.select("pattern", "value").join(known, "value").groupBy("pattern", "kind").agg(
            F.sum("score").alias("hits")
        )
        good = (
            hits.where(F.col("hits") >= MIN_SEEDS)
            .join(totals, "pattern")
            .withColumn("confidence", F.col("hits") / (F.col("total") + 1))
            .where(F.col("confidence") >= CONFIDENT)
        )
        unseen = edges.where("kind IS NULL").select("pattern", "value")
        scored = (
            unseen.join(good.select("pattern", "kind", "confidence"), "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
            .where(F.col("score") >= CONFIDENT)
            .groupBy("value")
            .agg(F.max(F.struct("score", "kind")).alias("best"))
            .select("value", "best.kind", "best.score")
        )
        found = scratch.save(scored)
        if found.isEmpty():
            break
        known = scratch.save(seeds.unionByName(found.select("value", "kind", "score")))
    return found.select("value", "kind")


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """`keep` (only `id_col` if not given), base_spans and added_spans: arrays of (start, kind, end), code points, end
    exclusive, kind as the place in KINDS, in order.

    Base spans have the fixed forms. They seed a bootstrap: the words around them, or the key they are given to,
    are lexical patterns, with the kinds of characters of the instance and without. Pattern and instance are the sides
    of a graph, which Spark scores in rounds: a pattern is as confident as the share of its different instances that are
    known, an instance as the patterns that point to it together. Confident patterns make new instances known, and
    these count for other patterns. Words and runs of digit groups that become known without having a fixed form are
    the added spans; they never overlap base spans, but a run may overlap a word of it.

    A pattern or instance of any frequency is one row per task after partial aggregation. Null texts count as
    empty and have no spans. Rows that repeat are scanned each and count once as instances; null ids are allowed.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    keep = [id_col] if keep is None else keep
    rows = scratch.save(_scanned(docs, text_col, keep).withColumn("_uid", F.monotonically_increasing_id()))
    found = _discovered(scratch, rows)
    added = (
        rows.select("_uid", F.explode("_seen").alias("i"))
        .where("i.kind IS NULL")
        .select("_uid", "i.start", "i.end", "i.value")
        .join(found, "value")
        .groupBy("_uid")
        .agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("added_spans"))
    )
    none = F.array().cast(f"array<{_SPAN}>")
    return rows.join(added, "_uid", "left").select(
        *keep, F.col("_base").alias("base_spans"), F.coalesce("added_spans", none).alias("added_spans")
    )


def _hidden(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    out, last = [], 0
    for start, kind, end in sorted(spans):
        if start >= last:
            out += [text[last:start], f"<{KINDS[kind].upper()}>"]
        last = max(last, end)
    return "".join(out) + text[last:] if out else text


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with each span in `text_col` replaced by its kind in angle brackets; other columns stay as they are.

    Spans that overlap go together under the kind of the first. Null texts stay null. Up to FEW discovered words are
    sent with the function, and no text is moved; with more, the spans are joined to the texts.
    """
    spark, schema = docs.sparkSession, docs.schema
    scratch = Scratch(spark, "pii")
    found = _discovered(scratch, scratch.save(_scanned(docs, text_col, [])))
    few = found.limit(FEW + 1).collect()
    known = {r["value"]: r["kind"] for r in few} if len(few) <= FEW else None
    source = docs if known is not None else find_personal_data(docs, id_col, text_col, keep=docs.columns)

    def spans_of(text: str | None, given: tuple | None) -> list[tuple[int, int, int]]:
        if given is not None:
            return [(s["start"], s["kind"], s["end"]) for part in given for s in part]
        base = base_spans(text or "")
        if not known:
            return base
        return base + [
            (start, known[value], end)
            for start, end, kind, value, _ in instances(text or "", base)
            if kind is None and value in known
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column(text_col).to_pylist()
                given = [None] * len(texts)
                if known is None:
                    given = zip(*(batch.column(c).to_pylist() for c in ("base_spans", "added_spans")))
                texts = [_hidden(t, spans_of(t, g)) for t, g in zip(texts, given)]
                columns = [pa.array(texts, f.type) if f.name == text_col else batch.column(f.name) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)
