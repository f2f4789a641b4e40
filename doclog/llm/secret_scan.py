"""Secrets: fixed forms, and what a character convolutional network finds among the other candidates."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, number_rows

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: A candidate is a run of secret characters with a letter and a digit, or a long one.
LEAST_MIXED, LEAST_PLAIN = 8, 20
#: Bytes before and behind a candidate that the network sees, and bytes of the candidate in one window. Longer
#: candidates are seen in windows that overlap by OVERLAP; the highest window counts.
BEFORE, WINDOW, BEHIND, OVERLAP = 24, 64, 8, 16
#: A candidate is learnt in pieces, which together have the windows of the whole. Pieces that one task learns from.
PIECE, SHARD = 4 * (WINDOW - OVERLAP) + OVERLAP, 4_096
#: Outputs are counted for calibration in steps of 1 / STEPS, up to REACH either way.
STEPS, REACH = 1_024, 64
#: Findings of a kind that it takes to learn it, one in FOLDS of which are kept for calibration.
LEAST_FINDINGS, FOLDS = 20, 4
#: Share of the calibration findings that the threshold of a kind must find.
RECALL = 0.95
#: Changed copies of each finding in training.
VARIANTS = 3
EMBEDDING, KERNEL, FILTERS, EPOCHS, STEP, RATE = 12, 5, 32, 6, 128, 3e-3

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".encode(), re.IGNORECASE
)
_ACCESS = re.compile(b"AKIA[A-Z0-9]+")
_WORDS = (b"passw", b"secret", b"token", b"api")
_SECRET = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
_HEX = bytes(104 if b in b"0123456789abcdef" else 32 for b in range(256))
_RUN = bytes(32 if b not in _SECRET else 57 if 48 <= b <= 57 else 120 for b in range(256))
_ANY = bytes(120 if b in _SECRET else 32 for b in range(256))


def _runs(mask: bytes, sign: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Runs of `sign`, `least` long or longer."""
    at = mask.find(sign * least)
    while at >= 0:
        end = mask.find(b" ", at)
        end = len(mask) if end < 0 else end
        yield at, end
        at = mask.find(sign * least, end)


def fixed_forms(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed forms, leftmost and without overlap in each kind, in order."""
    out = []
    low = data.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(data) if m.end() - m.start(1) >= LEAST_VALUE]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(a, 2, b) for a, b in _runs(data.translate(_HEX), b"h", LEAST_HEX)]
    return sorted(out)


def _trimmed(data: bytes, start: int, end: int) -> tuple[int, int]:
    while start < end and data[start] in b".=-":
        start += 1
    while end > start and data[end - 1] in b".-":
        end -= 1
    return start, end


def candidates(data: bytes) -> list[tuple[int, int]]:
    """(start, end) in bytes of the runs of secret characters that have a letter and a digit, or are long."""
    found = set()
    mask = data.translate(_RUN)
    at = mask.find(b"9")
    while at >= 0:
        start, end = mask.rfind(b" ", 0, at) + 1, mask.find(b" ", at)
        end = len(mask) if end < 0 else end
        a, b = _trimmed(data, start, end)
        if b - a >= LEAST_MIXED and not data[a:b].isdigit() and re.search(b"[A-Za-z]", data[a:b]):
            found.add((a, b))
        at = mask.find(b"9", end)
    for start, end in _runs(data.translate(_ANY), b"x", LEAST_PLAIN):
        a, b = _trimmed(data, start, end)
        if b - a >= LEAST_PLAIN:
            found.add((a, b))
    return sorted(found)


class _Places:
    """Places in code points of ascending places in bytes."""

    def __init__(self, data: bytes) -> None:
        self.data, self.plain = data, data.isascii()
        self.known = {0: 0}

    def add(self, places: set[int]) -> None:
        if self.plain:
            return
        last = at = 0
        for place in sorted(places):
            at += len(self.data[last:place].decode("utf-8", "replace"))
            last = place
            self.known[place] = at

    def of(self, place: int) -> int:
        return place if self.plain else self.known[place]


_SPAN = "struct<start:int,kind:int,end:int>"
_SEEN = "struct<start:int,end:int,label:int,before:binary,value:binary,behind:binary>"


def _scanned(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """`keep` columns, the fixed forms (_base), and the candidates with their surroundings (_seen). `label` has a bit
    for each kind whose fixed form overlaps the candidate."""
    schema = T.StructType(
        [
            *(docs.schema[c] for c in keep),
            *T._parse_datatype_string(f"_base array<{_SPAN}>, _seen array<{_SEEN}>").fields,
        ]
    )

    def look(text: str | None) -> tuple[list, list]:
        data = (text or "").encode("utf-8", "replace")
        base, cands = fixed_forms(data), candidates(data)
        places = _Places(data)
        places.add({p for s, _, e in base for p in (s, e)} | {p for c in cands for p in c})
        seen, reach, k = [], [0] * len(KINDS), 0
        for start, end in cands:
            while k < len(base) and base[k][0] < end:
                reach[base[k][1]] = max(reach[base[k][1]], base[k][2])
                k += 1
            label = sum(1 << kind for kind, last in enumerate(reach) if last > start)
            seen.append(
                dict(
                    start=places.of(start),
                    end=places.of(end),
                    label=label,
                    before=data[max(0, start - BEFORE) : start],
                    value=data[start:end],
                    behind=data[end : end + BEHIND],
                )
            )
        return [dict(start=places.of(s), kind=k, end=places.of(e)) for s, k, e in base], seen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                base, seen = zip(*map(look, batch.column("_scan").to_pylist()))
                columns = [batch.column(c) for c in keep]
                columns += [pa.array(v, arrow.field(n).type) for n, v in (("_base", base), ("_seen", seen))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select(*keep, F.col(text_col).alias("_scan")).mapInArrow(run, schema)


#: Signs of a window: 0 nothing, 1-95 printable ASCII, 96 the rest.
_SIGNS = 97
_SIGN = np.array([1 if b < 32 else b - 31 if b < 127 else 96 for b in range(256)], np.uint8)
_LENGTH = BEFORE + WINDOW + BEHIND


def windows(before: bytes, value: bytes, behind: bytes) -> list[np.ndarray]:
    """Signs of the candidate with its surroundings; several windows for a long one."""
    out = []
    for at in range(0, max(1, len(value) - OVERLAP), WINDOW - OVERLAP):
        row = np.zeros(_LENGTH, np.uint8)
        for place, part in ((BEFORE - len(before), before), (BEFORE, value[at : at + WINDOW]), (BEFORE + WINDOW, behind)):
            row[place : place + len(part)] = _SIGN[np.frombuffer(part, np.uint8)]
        out.append(row)
    return out


_INSIDE = np.zeros(_LENGTH, bool)
_INSIDE[BEFORE : BEFORE + WINDOW] = True
_PART = np.zeros((_LENGTH, 3), np.float32)
_PART[:BEFORE, 0] = _PART[BEFORE : BEFORE + WINDOW, 1] = _PART[BEFORE + WINDOW :, 2] = 1


@dataclass
class Network:
    """Embedded signs, one convolution, the highest of each filter in the candidate and around it and the mean in the
    candidate, and a linear output for each kind."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, rng: np.random.Generator) -> None:
        width = KERNEL * (EMBEDDING + 3)
        self.weights = {
            "embed": rng.normal(0, 0.5, (_SIGNS, EMBEDDING)),
            "filter": rng.normal(0, width**-0.5, (width, FILTERS)),
            "shift": np.zeros(FILTERS),
            "out": rng.normal(0, FILTERS**-0.5, (3 * FILTERS, len(KINDS))),
            "bias": np.zeros(len(KINDS)),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def _convolve(self, x: np.ndarray):
        w, n = self.weights, len(x)
        used = (x > 0)[:, :, None]
        signs = np.concatenate([w["embed"][x], np.broadcast_to(_PART, (n, *_PART.shape))], axis=2) * used
        half = KERNEL // 2
        wide = np.pad(signs, ((0, 0), (half, half), (0, 0)))
        patches = np.concatenate([wide[:, k : k + _LENGTH] for k in range(KERNEL)], axis=2)
        made = np.maximum(patches @ w["filter"] + w["shift"], 0) * used
        return used, patches, made

    def forward(self, x: np.ndarray):
        used, patches, made = self._convolve(x)
        inside, around = made[:, _INSIDE], made[:, ~_INSIDE]
        count = np.maximum(used[:, _INSIDE].sum(axis=1), 1)
        pooled = np.concatenate([inside.max(axis=1), around.max(axis=1), inside.sum(axis=1) / count], axis=1)
        return pooled @ self.weights["out"] + self.weights["bias"], (x, used, patches, made, count, pooled)

    def gradients(self, wrong: np.ndarray, state: tuple) -> dict[str, np.ndarray]:
        """Of the loss by each weight, given that by the outputs."""
        x, used, patches, made, count, pooled = state
        w, n = self.weights, len(x)
        back = wrong @ w["out"].T
        d = np.zeros_like(made)
        rows, cols = np.arange(n)[:, None], np.arange(FILTERS)[None, :]
        d[:, _INSIDE] += (back[:, 2 * FILTERS :] / count)[:, None, :]
        for k, where in ((0, np.flatnonzero(_INSIDE)), (1, np.flatnonzero(~_INSIDE))):
            top = where[made[:, where].argmax(axis=1)]
            d[rows, top, cols] += back[:, k * FILTERS : (k + 1) * FILTERS]
        d *= (made > 0) & used
        flat = d.reshape(-1, FILTERS)
        inner = (flat @ w["filter"].T).reshape(n, _LENGTH, KERNEL, EMBEDDING + 3)
        half = KERNEL // 2
        signs = np.zeros((n, _LENGTH + 2 * half, EMBEDDING), np.float32)
        for k in range(KERNEL):
            signs[:, k : k + _LENGTH] += inner[:, :, k, :EMBEDDING]
        embed = np.zeros_like(w["embed"])
        np.add.at(embed, x.reshape(-1), (signs[:, half : half + _LENGTH] * used).reshape(-1, EMBEDDING))
        return {
            "embed": embed,
            "filter": patches.reshape(-1, patches.shape[2]).T @ flat,
            "shift": flat.sum(axis=0),
            "out": pooled.T @ wrong,
            "bias": wrong.sum(axis=0),
        }

    def learn(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng: np.random.Generator, state: np.ndarray) -> np.ndarray:
        """One pass over the examples from `state` (weights, Adam's two means and its steps); the state after it.
        Logistic loss of each kind."""
        self.weights, mean, square, t = unpacked(state)
        order = rng.permutation(len(x))
        for at in range(0, len(x), STEP):
            some = order[at : at + STEP]
            logits, found = self.forward(x[some])
            wrong = (1 / (1 + np.exp(-logits)) - y[some]) * weight[some, None] / len(some)
            t += 1
            for k, g in self.gradients(wrong.astype(np.float32), found).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                step = (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-7)
                self.weights[k] -= (RATE * step).astype(np.float32)
        return packed(self.weights, mean, square, t)

    def logits(self, rows: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
        """Of each candidate and kind, the highest over its windows; a bounded number of windows at a time."""
        out = np.full((len(rows), len(KINDS)), -np.inf, np.float32)
        held: list[np.ndarray] = []
        owner: list[int] = []

        def flush() -> None:
            if held:
                np.maximum.at(out, np.array(owner), self.forward(np.stack(held))[0])
                held.clear()
                owner.clear()

        for k, row in enumerate(rows):
            for window in windows(*row):
                held.append(window)
                owner.append(k)
                if len(held) == 512:
                    flush()
        flush()
        return out


_SHAPES = {
    "embed": (_SIGNS, EMBEDDING),
    "filter": (KERNEL * (EMBEDDING + 3), FILTERS),
    "shift": (FILTERS,),
    "out": (3 * FILTERS, len(KINDS)),
    "bias": (len(KINDS),),
}


def packed(weights: dict, mean: dict, square: dict, t: float) -> np.ndarray:
    return np.concatenate([*(part[k].ravel() for part in (weights, mean, square) for k in _SHAPES), [t]]).astype(np.float64)


def unpacked(state: np.ndarray) -> tuple[dict, dict, dict, float]:
    parts, at = [], 0
    for _ in range(3):
        part = {}
        for k, shape in _SHAPES.items():
            n = int(np.prod(shape))
            part[k] = state[at : at + n].astype(np.float32).reshape(shape)
            at += n
        parts.append(part)
    return *parts, float(state[at])


@dataclass
class Model:
    """For each kind the calibration (slope, shift) of the network's output and the least probability of a finding, or
    None for kinds that were not learnt."""

    network: Network = field(default_factory=Network)
    kinds: list[tuple[float, float, float] | None] = field(default_factory=lambda: [None] * len(KINDS))

    def find(self, rows: list[tuple[bytes, bytes, bytes]]) -> list[int | None]:
        """Kind of each candidate, or None."""
        if not rows or not any(self.kinds):
            return [None] * len(rows)
        logits = self.network.logits(rows)
        best, kind = np.zeros(len(rows)), np.full(len(rows), -1)
        for k, known in enumerate(self.kinds):
            if known:
                p = probability(logits[:, k], *known[:2])
                better = (p >= known[2]) & (p > best)
                best[better], kind[better] = p[better], k
        return [int(k) if k >= 0 else None for k in kind]


def probability(logit: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * logit.astype(np.float64) + shift, -50, 50)))


def calibrate(logit: np.ndarray, y: np.ndarray, count: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the outputs (Platt's method, targets a little inside 0 and 1);
    `count` tells how often each occurs."""
    n = np.ones(len(y)) if count is None else count
    found, rest = (n * y).sum(), (n * (1 - y)).sum()
    target = np.where(y > 0, (found + 1) / (found + 2), 1 / (rest + 2))
    x = np.stack([logit.astype(np.float64), np.ones(len(logit))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (n * (p - target)) + 1e-6 * (w - [1, 0]))
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def threshold(p: np.ndarray, y: np.ndarray, recall: float = RECALL, count: np.ndarray | None = None) -> float:
    """The highest probability at which `recall` of the findings are still found, but 0.5 at least."""
    hits, n = p[y > 0], np.ones(int((y > 0).sum())) if count is None else count[y > 0]
    order = np.argsort(hits, kind="stable")
    upto = np.cumsum(n[order])
    return max(0.5, float(hits[order][np.searchsorted(upto, np.floor((1 - recall) * upto[-1]), side="right")]))


Row = tuple[bytes, bytes, bytes, int]
_ASSIGNED = re.compile(rb"""["']?\x20*[:=]\x20*["']?$""")


def _variants(findings: list[Row], others: list[Row], rng: np.random.Generator) -> list[Row]:
    """Findings in forms that the fixed ones miss: another sign or none between key and value, a hexadecimal value in
    upper case or cut short, or the value among the words around another candidate."""
    out = []
    for before, value, behind, label in findings * VARIANTS:
        if label & 1 and rng.random() < 0.5 and (m := _ASSIGNED.search(before)):
            sign = (b" is ", b" ", b" -> ", b" was '", b"(")[rng.integers(5)]
            before = (before[: m.start()] + sign)[-BEFORE:]
        if label & 4:
            how = rng.integers(3)
            value = value.upper() if how == 0 else value[: rng.integers(12, LEAST_HEX)] if how == 1 else value
            if others and rng.random() < 0.3:
                before, _, behind, _ = others[rng.integers(len(others))]
                label &= ~1
        out.append((before, value, behind, label))
    return out


def _figures(part: list[Row]) -> tuple[list[tuple[bytes, bytes, bytes]], np.ndarray]:
    return [r[:3] for r in part], np.array([[r[3] >> k & 1 for k in range(len(KINDS))] for r in part], np.float32)


def _shard_rows(table: pa.Table, seed: list[int]) -> list[Row]:
    """Findings, their variants and the others of a shard, the same whenever they are read."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("k", "before", "value", "behind", "label"))))
    findings, others = ([r[1:] for r in rows if bool(r[4]) == found] for found in (True, False))
    return findings + _variants(findings, others, np.random.default_rng(seed)) + others


def train(examples: DataFrame, shards: int) -> dict[int, Network]:
    """A network for each `net` of the examples (columns net, shard, found, k, before, value, behind, label).

    In each of EPOCHS rounds every shard goes on from the same weights with one pass over its examples, and the means of
    what the shards come to are the weights of the next round. Sums are decimal, so their order does not matter. Findings
    and others weigh the same in total; every window of a candidate is an example.
    """
    sizes = examples.groupBy("net").agg(F.count_if(F.col("found")).alias("found"), F.count("*").alias("rows")).collect()
    found = {r.net: r.found * (1 + VARIANTS) for r in sizes}
    others = {r.net: r.rows - r.found for r in sizes}
    networks, states = {net: Network() for net in found}, {}
    for net, network in networks.items():
        network.start(np.random.default_rng([7, net]))
        none = {k: np.zeros(shape) for k, shape in _SHAPES.items()}
        states[net] = packed(network.weights, none, none, 0)
    dealt = examples.repartition(shards * len(found), "net", "shard")

    def one_round(epoch: int, states: dict[int, np.ndarray]) -> DataFrame:
        def learn(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            net, shard = (v.as_py() for v in key)
            given, y = _figures(_shard_rows(table, [7, net, shard]))
            each = [windows(*r) for r in given]
            owner = np.repeat(np.arange(len(given)), [len(w) for w in each])
            share = np.where(y.any(axis=1), 0.5 / max(1, found[net]), 0.5 / max(1, others[net]))
            weight = share * (found[net] + others[net])
            x = np.stack([w for some in each for w in some])
            rng = np.random.default_rng([7, net, shard, epoch])
            state = Network().learn(x, y[owner], weight[owner], rng, states[net])
            return pa.table({"net": pa.array([net], pa.int32()), "state": pa.array([state.tolist()], pa.list_(pa.float64()))})

        return dealt.groupBy("net", "shard").applyInArrow(learn, "net int, state array<double>")

    for epoch in range(EPOCHS):
        # A network has a fixed size, whatever the number of shards.
        made = one_round(epoch, states).select("net", F.posexplode("state"))
        total = F.sum(F.col("col").cast("decimal(38,18)")).cast("double") / F.count("*")
        for r in made.groupBy("net", "pos").agg(total.alias("mean")).collect():
            states[r.net][r.pos] = r["mean"]
    for net, network in networks.items():
        network.weights = unpacked(states[net])[0]
    return networks


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {w for b in batch.column(0).to_pylist() for w in re.findall(rb"[A-Za-z\x80-\xff]{4,}", b)}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], names=["value"])


_ROW = ("before", "value", "behind")


def _examples(scratch: Scratch, each: DataFrame) -> tuple[DataFrame, int]:
    """Pieces of all candidates and the words before them (columns of _ROW, label), numbered by `k` among the findings
    and among the others; and how many there are."""
    starts = F.sequence(F.lit(0), F.greatest(F.length("value") - OVERLAP - 1, F.lit(0)), F.lit(PIECE - OVERLAP))
    pieces = F.transform(starts, lambda at: F.substring(F.col("value"), at + 1, F.lit(PIECE)))
    rows = each.select("before", F.explode(pieces).alias("value"), "behind", "label")
    # Prose is no finding either, whatever the table's own candidates are.
    words = each.select("before").mapInArrow(_words, "value binary").distinct()
    none = F.lit(b"").cast("binary")
    rows = rows.unionByName(words.select(none.alias("before"), "value", none.alias("behind"), F.lit(0).alias("label")))
    known = scratch.save(rows.groupBy(*_ROW).agg(F.max("label").alias("label")).withColumn("found", F.col("label") > 0))
    size = known.count()
    return scratch.save(number_rows(known, size, ["found"], ["value", "before", "behind"], "k")), size


def fit(scratch: Scratch, rows: DataFrame) -> Model:
    """A network trained on findings: candidates that a fixed form overlaps, with its kind, and other candidates.

    All of them are learnt from, copies once, long ones in pieces; they are dealt over shards, and tasks learn from a
    shard each. One in FOLDS of them calibrates each kind's output and sets its threshold, the highest that finds RECALL
    of its findings there. Others that look like findings to a network trained on the other half of the others do not
    train: secrets that the fixed forms miss must not teach that they are none.
    """
    seen = rows.select(F.explode("_seen").alias("i")).select("i.before", "i.value", "i.behind", "i.label")
    each = scratch.save(seen.groupBy(*_ROW).agg(F.max("label").alias("label")))
    counts = each.agg(*[F.count_if(F.expr(f"label & {1 << k} > 0")) for k in range(len(KINDS))]).first()
    learnt = [n >= LEAST_FINDINGS for n in counts]
    if not any(learnt):
        return Model()
    known, size = _examples(scratch, each)
    shards = size // SHARD + 1
    dealt = known.withColumn("shard", F.expr(f"int(k div {2 * FOLDS} % {shards})"))
    side = F.expr("int(k % 2)")
    halves = dealt.withColumn("net", F.explode(F.when(F.col("found"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(side))))
    judges = train(halves, shards)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [*zip(*(batch.column(c).to_pylist() for c in _ROW))]
            keep = np.array(batch.column("found").to_pylist(), bool)
            sides = np.array(batch.column("k").to_pylist(), np.int64) % 2
            for net, judge in judges.items():
                some = np.flatnonzero(~keep & (sides != net))
                keep[some] = judge.logits([judged[i] for i in some]).max(axis=1, initial=-np.inf) < 0
            yield batch.filter(pa.array(keep))

    # In the order of their numbers, findings and others are dealt to the folds; sides of the others alternate.
    held = F.when(F.col("found"), F.expr(f"k % {FOLDS} = 0")).otherwise(F.expr(f"k div 2 % {FOLDS} = 0"))
    kept = scratch.save(dealt.mapInArrow(clean, dealt.schema).withColumns({"held": held, "net": F.lit(2)}))
    network = train(kept.where("not held"), shards)[2]

    def outputs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        given, y = _figures(_shard_rows(table, [7, 3, key[0].as_py()]))
        bins = np.rint(np.clip(network.logits(given), -REACH, REACH) * STEPS).astype(np.int64)
        cells = np.stack([np.tile(np.arange(len(KINDS)), len(given)), bins.ravel(), y.ravel().astype(np.int64)], axis=1)
        some, n = np.unique(cells, axis=0, return_counts=True)
        return pa.table({**{c: some[:, k] for k, c in enumerate(("kind", "bin", "y"))}, "n": n.astype(np.int64)})

    judged = kept.where("held").repartition(shards, "shard").groupBy("shard")
    # At most as many cells as there are kinds and steps, whatever the number of candidates.
    cells = judged.applyInArrow(outputs, "kind long, bin long, y long, n long").groupBy("kind", "bin", "y")
    by_kind: list[list] = [[] for _ in KINDS]
    for r in cells.agg(F.sum("n").alias("n")).orderBy("kind", "bin", "y").collect():
        by_kind[r.kind].append((r.bin / STEPS, r.y, r.n))
    model = Model(network)
    for k, found in enumerate(by_kind):
        logit, y, n = (np.array(v, np.float64) for v in zip(*found)) if found else (np.zeros(0),) * 3
        if learnt[k] and y.any() and not y.all():
            slope, shift = calibrate(logit, y, n)
            model.kinds[k] = (slope, shift, threshold(probability(logit, slope, shift), y, count=n))
    return model


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` (only `id_col` if not given), base_spans and added_spans: arrays of (start, kind, end), code points, end
    exclusive, kind as the place in KINDS, in order.

    Base spans have the fixed forms. Candidates are all runs of secret characters with a letter and a digit (8 and more) or
    of any characters (20 and more), whole texts and whole runs. The candidates that a fixed form overlaps are labelled
    findings; a network of characters learns from them, and from variants, what a secret and its surroundings look
    like, and scores every other candidate in windows; what reaches the calibrated threshold of a kind is an added span
    of that kind. Added spans never overlap base spans.

    Texts are read once, candidates are kept with their surroundings, and no text moves. The model has a fixed size and
    is sent with the function. Kinds with fewer than LEAST_FINDINGS findings are not learnt. Null texts count as empty
    and have no spans; rows that repeat are scanned each; null ids are allowed; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    keep = [id_col] if keep is None else keep
    rows = scratch.save(_scanned(docs, text_col, keep))
    model = fit(scratch, rows)
    schema = T.StructType(
        [
            *(docs.schema[c] for c in keep),
            *T._parse_datatype_string(f"base_spans array<{_SPAN}>, added_spans array<{_SPAN}>").fields,
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                open_ = [(k, i) for k, seen in enumerate(batch.column("_seen").to_pylist()) for i in seen if not i["label"]]
                kinds = model.find([(i["before"], i["value"], i["behind"]) for _, i in open_])
                added: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                for (k, i), kind in zip(open_, kinds):
                    if kind is not None:
                        added[k].append(dict(start=i["start"], kind=kind, end=i["end"]))
                columns = [batch.column(c) for c in keep] + [batch.column("_base").cast(arrow.field("base_spans").type)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(added, arrow.field("added_spans").type)], schema=arrow)

    return rows.mapInArrow(run, schema)
