"""BPE encoding as a transducer with bounded lookahead, and decoding as an incremental state machine."""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .vocab import Memo, open_tokenizer, pieces

#: Characters that one output batch holds at most, unless a single text is longer.
BATCH_CHARS = 1 << 22
#: Characters of a piece or pretoken that is kept in a memo at most.
LONGEST_KEY = 256
#: Characters that are pretokenized together; then text is cut at the next safe place: after a letter or digit where a
#: character of another kind follows, or before the end of a line. No pretoken spans these.
STRETCH = 1 << 12
_SAFE = re.compile(r"(?<=[A-Za-z])(?=[\x00-@\[-`{-~])|(?<=[0-9])(?=[!-/:-~\n])|(?<=[!-~])(?=\n)")
#: Letters in any version of Unicode.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")
#: Tokens that the decoder takes at a time.
DECODE_TOKENS = 1 << 16


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols after a token's end beyond which no text can change the token.

    When more text takes a token away from a merge, the token to the left of it is free for a merge of its own, which can
    again take a token away further left. Each merge of such a chain ranks behind the one before, and its right part is
    the left part or the product of the one before. The longest chain, measured in symbols, bounds how far a change
    reaches; merges are visited in rank order, so each looks up the chains that can precede it.
    """
    reach: dict[str, int] = {}
    longest = 0
    for left, right in merges:
        here = reach.get(right, len(right)) + len(left)
        longest = max(longest, here)
        for end in (left, left + right):
            if here > reach.get(end, 0):
                reach[end] = here
    return longest


class Encoder:
    """Token ids of a byte-level BPE file, as little-endian unsigned 32-bit numbers."""

    def __init__(self, name: str) -> None:
        tokenizer = open_tokenizer(name)
        spec = json.loads(tokenizer.to_str())
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self._rank = {pair: n for n, pair in enumerate(merges)}
        self._ids = spec["model"]["vocab"]
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._cuts = re.compile("|".join(map(re.escape, sorted(self._special, key=len, reverse=True))))
        self._pretokens = tokenizer.pre_tokenizer.pre_tokenize_str
        self.lookahead = sufficient_lookahead(merges)
        self.window = 4 * self.lookahead
        self._symbols = {b: c for b, c in enumerate(byte_symbols())}
        self._pieces = Memo(self._piece)
        self._words = Memo(self._word)

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of `text`, a stretch at a time. What is kept meanwhile does not grow with the text."""
        first, *rest = pieces(text)
        yield self._plain(first)
        for at in range(0, len(rest), 1 << 14):
            yield b"".join(map(self._known, rest[at : at + (1 << 14)]))
            self._pieces.trim()
            self._words.trim()

    def _known(self, piece: str) -> bytes:
        return self._pieces[piece] if len(piece) <= LONGEST_KEY else self._piece(piece)

    def _piece(self, piece: str) -> bytes:
        """A piece after its space. Letters, with a comma or stop behind them or not, need no pretokenizer."""
        if piece and piece[-1] in ",." and _LETTERS.fullmatch(piece, 0, len(piece) - 1):
            return self._ids_of(self._spaced(piece[:-1])) + self._words[piece[-1]]
        if _LETTERS.fullmatch(piece):
            return self._ids_of(self._spaced(piece))
        return self._plain(" " + piece)

    def _spaced(self, letters: str) -> str:
        return (b" " + letters.encode()).decode("latin-1").translate(self._symbols)

    def _plain(self, text: str) -> bytes:
        """The ids of text with special strings in it; these cut it, from left to right."""
        out, at = [], 0
        for m in self._cuts.finditer(text) if self._special else ():
            out += [self._between(text[at : m.start()]), array("I", [self._special[m.group()]]).tobytes()]
            at = m.end()
        return b"".join(out) + self._between(text[at:] if at else text)

    def _between(self, text: str) -> bytes:
        out, at = [], 0
        while at < len(text):
            cut = _SAFE.search(text, at + STRETCH) if len(text) - at > STRETCH else None
            end = cut.start() if cut else len(text)
            out += [self._ids_of(w) for w, _ in self._pretokens(text[at:end])]
            at = end
        return b"".join(out)

    def _ids_of(self, word: str) -> bytes:
        return self._words[word] if len(word) <= LONGEST_KEY else self._word(word)

    def _word(self, word: str) -> bytes:
        ids = self._ids
        if len(word) <= self.window:
            return array("I", [ids[t] for t in self._merge(word)]).tobytes()
        return array("I", [ids[t] for t in self.stream(word)]).tobytes()

    def stream(self, symbols: str) -> Iterator[str]:
        """Tokens of one long pretoken: a window is merged, its tokens are emitted as far as they are stable, and the
        rest starts the next window. A token is stable once `lookahead` symbols follow it."""
        start = 0
        while len(symbols) - start > self.window:
            end = start + self.window
            for token in self._merge(symbols[start:end]):
                if start + len(token) + self.lookahead > end:
                    break
                yield token
                start += len(token)
        yield from self._merge(symbols[start:])

    def _merge(self, symbols: str) -> list[str]:
        if len(symbols) > 64:
            return self._merge_long(symbols)
        parts, rank, none = list(symbols), self._rank.get, len(self._rank)
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]  # of the pair that begins at each part
        while ranks and (best := min(ranks)) != none:
            at = ranks.index(best)
            parts[at] += parts.pop(at + 1)
            ranks.pop(at)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
        return parts

    def _merge_long(self, symbols: str) -> list[str]:
        """The same with a heap of the pairs that can merge, (rank, place)."""
        n, rank = len(symbols), self._rank.get
        part: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank((symbols[i], symbols[i + 1]))) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or rank((part[i], part[j])) != r:
                continue
            part[i], part[j] = part[i] + part[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((part[i], part[k]))) is not None:
                    heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank((part[h], part[i]))) is not None:
                heappush(heap, (r, h))
        return [p for p in part if p is not None]


class Decoder:
    """Text of token ids. Bytes of a character that is cut between tokens wait in the state; bytes that can't become a
    character give the replacement character."""

    def __init__(self, name: str) -> None:
        spec = json.loads(open_tokenizer(name).to_str())
        symbols = {s: b for b, s in enumerate(byte_symbols())}
        tokens = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._bytes = [b""] * (max(tokens.values()) + 1)
        for token, n in tokens.items():
            plain = all(c in symbols for c in token)
            self._bytes[n] = bytes(symbols[c] for c in token) if plain else token.encode()

    def decode(self, ids: bytes) -> str:
        state = codecs.getincrementaldecoder("utf-8")("replace")
        numbers, table, out = np.frombuffer(ids, "<u4"), self._bytes, []
        for at in range(0, len(numbers), DECODE_TOKENS):
            some = numbers[at : at + DECODE_TOKENS].tolist()
            out.append(state.decode(b"".join(map(table.__getitem__, some))))
        out.append(state.decode(b"", final=True))
        return "".join(out)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=None)
def _encoder(name: str) -> Encoder:
    return Encoder(name)


@lru_cache(maxsize=None)
def _decoder(name: str) -> Decoder:
    return Decoder(name)


def _rows(batch: pa.RecordBatch, added: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    values = {f.name: batch.column(f.name) for f in schema if f.name not in added}
    values |= {k: pa.array(v, schema.field(k).type) for k, v in added.items()}
    return pa.RecordBatch.from_arrays([values[f.name] for f in schema], schema=schema)


def _small(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows that hold about BATCH_CHARS, or one longer row."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = size = 0
    for n, length in enumerate(lengths):
        if n > start and size + length > BATCH_CHARS:
            yield batch.slice(start, n - start), texts.slice(start, n - start).to_pylist()
            start, size = n, 0
        size += length
    if start < len(lengths):
        yield batch.slice(start), texts.slice(start).to_pylist()


def encode_decode(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    text_col: str = "text",
    keep: list[str] | None = None,
    decode: bool = True,
) -> DataFrame:
    """`keep` (all columns but the text), ids (binary, little-endian unsigned 32-bit) and decoded (text of the ids).

    Special strings inside a text become their ids and come back as text; nothing is added, cut or filled. Null texts
    count as empty: no ids, decoded "". A column of `docs` named ids or decoded is left out. Each row depends on itself
    only, so there is no shuffle, and rows that repeat or tie need no rule. Texts of any length are encoded in bounded
    windows; output leaves in batches of bounded size.
    """
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text_col, "ids", "decoded")] if keep is None else keep
    added = [T.StructField("ids", T.BinaryType()), *([T.StructField("decoded", T.StringType())] if decode else [])]
    schema = T.StructType([*(docs.schema[c] for c in keep), *added])

    source = "_text"
    while source in keep:
        source += "_"

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        encoder, decoder = _encoder(tokenizer), _decoder(tokenizer)
        for batch in batches:
            for part, texts in _small(batch, batch.column(source)):
                ids = [b"".join(encoder.encode(t or "")) for t in texts]
                made = {"ids": ids} | ({"decoded": [decoder.decode(x) for x in ids]} if decode else {})
                yield _rows(part, made, arrow)

    return docs.select(*keep, F.col(text_col).alias(source)).mapInArrow(run, schema)
