"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside each partition.

A task cuts its texts into units that the split pattern treats separately, takes each
different word once, lays the words out as rows of (word, position) and token and lets a
recursive query join neighbouring tokens with the merge table. Each step contracts every
word's leftmost pair of minimum rank; a word leaves the recursion when no pair is left.
Decoding joins token rows with the vocabulary, in the order of their places, and cuts the
joined bytes where a list ends.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallywatch.llm.common import map_batches, other_columns, replace_columns, table, text_or_empty

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
KNOWN_UNITS = 900_000
"""Units a Python worker remembers before it forgets them; only speed depends on it."""
CHUNK = 24_000_000
"""Characters whose words are encoded together."""
LONG_WORD = 48
QUERY_WORDS = 50_000
"""Words of one recursive query, which keeps the rows of all its steps."""
DECODED_TOKENS = 500_000
"""Tokens that one query decodes; a longer text is decoded alone."""

ENCODE = """
WITH RECURSIVE step(place, token, done) AS (
  SELECT place, token, false FROM start
  UNION ALL
  (WITH paired AS MATERIALIZED (
     SELECT place, token, lead(token) OVER w AS after, lead(place) OVER w AS next
     FROM step WHERE NOT done WINDOW w AS (ORDER BY place)),
   best AS (
     SELECT place >> 32 AS word,
            min((merged::BIGINT << 32) + (place & 4294967295)) AS pair,
            min_by(next, (merged::BIGINT << 32) + (place & 4294967295)) AS gone
     FROM paired JOIN merges ON l = token AND r = after
     WHERE place >> 32 = next >> 32
     GROUP BY 1)
   SELECT place,
          CASE WHEN place & 4294967295 = pair & 4294967295
               THEN (pair >> 32)::INTEGER ELSE token END,
          word IS NULL
   FROM paired LEFT JOIN best ON word = place >> 32
   WHERE gone IS DISTINCT FROM place)
)
SELECT place, token FROM step WHERE done ORDER BY place
"""

DECODE = """
SELECT place, piece FROM coded JOIN vocabulary USING (token) ORDER BY place
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def token_splits(ranks: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """Every way in which two tokens join to a third one."""
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                yield left, right, rank


def token_rows(sizes: np.ndarray, tokens: np.ndarray) -> pa.Table:
    """One row per token; ``place`` holds the word's number above the position in it."""
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    word = np.repeat(np.arange(len(sizes)), sizes)
    return pa.table({
        "place": pa.array((word << 32) + np.arange(len(tokens)) - begin),
        "token": pa.array(tokens.astype(np.int32)),
    })


class Codec:
    """One DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.joins = np.zeros((256, 256), bool)
        for token in ranks:
            raw = np.frombuffer(token, np.uint8)
            self.joins[raw[:-1], raw[1:]] = True
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "700MB"})
        left, right, merged = zip(*token_splits(ranks))
        columns = {"l": left, "r": right, "merged": merged}
        self._load("merges", {k: pa.array(v, pa.int32()) for k, v in columns.items()})
        self._load("vocabulary", {
            "token": pa.array(list(ranks.values()), pa.int32()),
            "piece": pa.array([t.decode("latin-1") for t in ranks]),  # a character for each byte
        })

    def _load(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.db.register("loaded", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM loaded")
        self.db.unregister("loaded")

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def parts(self, raw: bytes) -> list[bytes]:
        """A long word cut where no token holds both neighbouring bytes: no merge crosses it."""
        if len(raw) < LONG_WORD:
            return [raw]
        codes = np.frombuffer(raw, np.uint8)
        cuts = [0, *(np.flatnonzero(~self.joins[codes[:-1], codes[1:]]) + 1).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def contract(self, words: list[bytes]) -> pa.Array:
        """Token ids of every (not empty) word as a list array, by the recursive query."""
        parts = [pa.array([], pa.list_(pa.int32()))]
        for begin in range(0, len(words), QUERY_WORDS):
            some = words[begin:begin + QUERY_WORDS]
            sizes = np.fromiter(map(len, some), np.int64, len(some))
            tokens = self.byte_ids[np.frombuffer(b"".join(some), np.uint8)]
            found = self._query(ENCODE, "start", token_rows(sizes, tokens)).combine_chunks()
            word = found.column("place").to_numpy() >> 32  # in order, so a word's rows are a run
            ends = np.searchsorted(word, np.arange(len(some) + 1))
            parts.append(pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.concat_arrays(found.column("token").chunks)))
        return pa.concat_arrays(parts)

    def decode(self, coded: pa.Array) -> list[bytes]:
        """Bytes of every id list."""
        sizes = coded.value_lengths().to_numpy(zero_copy_only=False)
        tokens = coded.flatten().to_numpy(zero_copy_only=False)
        found = self._query(DECODE, "coded", token_rows(sizes, tokens))
        if not found.num_rows:
            return [b""] * len(coded)
        # in order, so the pieces of a list are a run of the column's characters
        pieces = pa.concat_arrays(found.column("piece").chunks).cast(pa.large_string())
        begin = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:]
        text, word = pieces.buffers()[2].to_pybytes(), found.column("place").to_numpy() >> 32
        ends = begin[np.searchsorted(word, np.arange(len(coded) + 1))].tolist()
        return [text[a:b].decode().encode("latin-1") for a, b in zip(ends, ends[1:])]

    def code(self, words: list[bytes]) -> pa.Array:
        """Ids of every word. One that is a token stays whole; the parts of a long one are
        contracted by themselves."""
        pieces = [[w] if w in self.ranks else self.parts(w) for w in words]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = [p for ps in pieces for p in ps]
        known = np.array([self.ranks.get(p, -1) for p in flat], np.int64)
        rest = np.flatnonzero(known < 0)
        spread = self.contract([flat[i] for i in rest])
        lengths = np.ones(len(flat), np.int64)
        lengths[rest] = spread.value_lengths().to_numpy(zero_copy_only=False)
        ids = np.empty(int(lengths.sum()), np.int32)
        of_rest = np.repeat(known < 0, lengths)
        ids[of_rest] = spread.flatten().to_numpy(zero_copy_only=False)
        ids[~of_rest] = known[known >= 0]
        by_piece = np.concatenate([[0], np.cumsum(lengths)])
        ends = by_piece[np.concatenate([[0], np.cumsum(sizes)])]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))


UNSAFE = re.compile(r"\s\s|^\s|\s$")
"""Texts in which white space meets white space, or an end, are split as a whole."""

def units_of(text: str) -> tuple[str, list[str]]:
    """The text cut at single spaces between other characters: the first unit, and the
    others without the space before them. The split pattern never joins across such a
    place, so equal units always give equal words."""
    if UNSAFE.search(text):
        return text, []
    first, *rest = text.split(" ")
    return first, rest


class UnitCache:
    """What units become, remembered within bounds: ids as lists, or as decimal text."""

    def __init__(self, codec: Codec, as_text: bool):
        self.codec, self.as_text = codec, as_text
        self.words: dict[str, object] = {}
        self.units: dict[str, object] = {}
        self.firsts: dict[str, object] = {}

    def split(self, unit: str) -> list[str]:
        return [unit] if unit.isalpha() else self.codec.pattern.findall(unit)

    def merge(self, parts: list):
        if self.as_text:
            return ",".join(parts)
        return [i for ids in parts for i in ids]

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        coded = self.codec.code([w.encode() for w in new])
        if self.as_text:
            coded = pc.binary_join(coded.cast(pa.list_(pa.string())), ",")
        self.words.update(zip(new, coded.to_pylist()))

    def fill(self, texts: list[tuple[str, list[str]]]) -> None:
        if len(self.units) + len(self.firsts) > KNOWN_UNITS:
            for memory in (self.words, self.units, self.firsts):
                memory.clear()
        rest = set().union(*[rest for _, rest in texts]).difference(self.units)
        # a letter run after a space is one word of the split pattern
        split = {u: [" " + u] if u.isalpha() else self.codec.pattern.findall(" " + u)
                 for u in rest}
        first = {u: self.split(u) for u, _ in texts if u not in self.firsts}
        self.learn({w for found in (split, first) for ws in found.values() for w in ws})
        words = self.words
        for memory, found in ((self.units, split), (self.firsts, first)):
            for unit, ws in found.items():
                memory[unit] = (
                    words[ws[0]] if len(ws) == 1 else self.merge([words[w] for w in ws]))

    def coded(self, text: tuple[str, list[str]]):
        first, rest = text
        if not first and not rest:
            return self.merge([])
        return self.merge([self.firsts[first], *map(self.units.__getitem__, rest)])


def decode_lists(codec: Codec, lists: list[np.ndarray]) -> Iterator[bytes]:
    """Bytes of every id list, as many lists at a time as have DECODED_TOKENS together."""
    begin, size = 0, 0
    for end, ids in enumerate([*lists, None]):
        if begin < end and (ids is None or size + len(ids) > DECODED_TOKENS):
            block = lists[begin:end]
            ends = np.cumsum([0, *map(len, block)]).astype(np.int32)
            yield from codec.decode(pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.concatenate(block).astype(np.int32))))
            begin, size = end, 0
        size += 0 if ids is None else len(ids)


_caches: dict[tuple, UnitCache] = {}


def worker_cache(ranks: dict[bytes, int], pattern: str, as_text: bool) -> UnitCache:
    """The worker's own memory for this vocabulary, kept from task to task."""
    key = (hash(frozenset(ranks.items())), pattern, as_text)
    if key not in _caches:
        _caches.clear()
        _caches[key] = UnitCache(Codec(ranks, pattern), as_text)
    return _caches[key]


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts, about CHUNK characters at a time."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _encoded(docs: DataFrame, path: str, pattern: str, as_text: bool, finish: Callable,
             added: str) -> DataFrame:
    """Columns of ``docs`` but ``text``, then what ``finish`` makes of the ids of some texts.
    Columns with the name of an added one are replaced."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # one vocabulary
    extra = StructType.fromDDL(added)
    others = other_columns(docs, extra.names)
    schema = StructType([docs.schema[c] for c in others] + extra.fields)

    def make():
        known = worker_cache(ranks.value, pattern, as_text)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for part in chunks([t or "" for t in batch.column("text").to_pylist()]):
                split = [units_of(text) for text in part]
                known.fill(split)
                rows += finish(known.codec, [known.coded(units) for units in split])
            return replace_columns(batch, ["text"], **{
                f.name: pa.array(c, f.type)
                for f, c in zip(to_arrow_schema(extra), zip(*rows))
            })

        return step

    return map_batches(docs.select(*others, text_or_empty()), make, schema)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``ids``: the token ids of the whole text, in
    order, without special tokens. Null and empty texts have none."""
    return _encoded(
        docs, path, pattern, False, lambda codec, coded: [(ids,) for ids in coded],
        "ids array<int>")


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns of ``coded`` but ``ids``, then ``raw``: the bytes of the ids. Null: empty."""
    ranks = coded.sparkSession.sparkContext.broadcast(read_ranks(path))
    others = other_columns(coded, ["ids", "raw"])
    schema = StructType(
        [coded.schema[c] for c in others] + StructType.fromDDL("raw binary").fields)

    def make():
        codec = Codec(ranks.value, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = pc.coalesce(batch.column("ids"), pa.scalar([], pa.list_(pa.int32())))
            return replace_columns(batch, ["ids"], raw=pa.array(codec.decode(ids), pa.binary()))

        return step

    return map_batches(coded.select(*others, "ids"), make, schema)


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``n_tokens`` and the SHA-256 of the ids
    (decimal, joined by commas) and of the bytes that they decode to."""

    def finish(codec: Codec, coded: list[str]) -> list[tuple[int, str, str]]:
        lists = [np.fromstring(ids, np.int32, sep=",") if ids else np.empty(0, np.int32)
                 for ids in coded]
        return [
            (len(found), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
            for found, ids, raw in zip(lists, coded, decode_lists(codec, lists))
        ]

    return _encoded(docs, path, pattern, True, finish,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of their round trip."""
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digest_documents(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
