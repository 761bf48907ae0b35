"""Benchmark passages in documents, by an FM-index per shard of the corpus.

Words that no test phrase holds can be in no occurrence, so all of them are one symbol, of which
each place counts as different and smaller than any word. A task lays the words of its
documents on end, sorts their suffixes, and keeps the Burrows-Wheeler transform as a wavelet
tree over bit vectors with counted blocks. Test phrases are searched backwards, all together:
each step narrows a phrase's range of suffixes by two ranks. What is left are its occurrences,
whose places are found by walking back to the next sampled suffix position. The words under the
occurrences are merged into spans.

The phrases are broadcast in blocks of bounded size; a benchmark above that bound takes one
pass over the documents for each block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.common import other_columns, prepare, stored, table, text_or_empty

WINDOW = 10
SHARD_WORDS = 1_000_000
"""Words after which a task closes a shard; a longer document is cut, with overlaps."""
SAMPLE = 16
"""One of so many suffix positions is kept, besides those behind an unknown word."""
BLOCK_BYTES = 16_000_000
"""Bytes of benchmark texts whose phrases are broadcast at a time."""
KEY_BITS = 63

SEPARATORS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256))
"""What each byte of a text becomes: capitals small letters, all that is no word a space."""
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
"""A word of a text before its capitals are made small."""


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(SEPARATORS).split()


# --- suffixes -------------------------------------------------------------------------


def suffix_order(codes: np.ndarray, bits: int) -> np.ndarray:
    """All suffixes of ``codes`` in order. 0 stands for a different symbol at each place, smaller
    than any other and the smaller the earlier; the last code must be 0.

    Suffixes are sorted by their first symbols, packed up to the first 0; those that hold a 0
    there are told apart by it. The others are sorted by rank and the rank of the suffix behind
    the symbols known so far, which doubles these each time.
    """
    n = len(codes)
    packed = max(1, min(4, KEY_BITS // bits))
    key, ended = np.zeros(n, np.int64), np.zeros(n, bool)
    for step in range(packed):
        following = np.concatenate([codes[step:], np.zeros(min(step, n), codes.dtype)])
        ended |= following == 0
        key = (key << bits) | np.where(ended, 0, following)
    words = np.flatnonzero(codes)
    by_key = words[np.argsort(key[words], kind="stable")]
    order = np.concatenate([np.flatnonzero(codes == 0), by_key])
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    # equal keys that hold no 0 share the rank of the first of them, until they are told apart
    values = key[by_key]
    new = np.append(True, values[1:] != values[:-1])[:len(values)] | ended[by_key]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    tied = ~new
    tied[:-1] |= ~new[1:]
    rank[by_key] = len(order) - len(by_key) + first
    depth = packed
    open_ = by_key[tied]
    while len(open_):
        # within a word run longer than ``depth``, so there is a suffix at that distance
        ranked = open_[np.lexsort((rank[open_ + depth], rank[open_]))]
        own, behind = rank[ranked], rank[ranked + depth]
        group = np.append(True, own[1:] != own[:-1])
        new = group | np.append(True, behind[1:] != behind[:-1])
        place = np.arange(len(ranked))
        start = np.maximum.accumulate(np.where(group, place, 0))
        order[own + place - start] = ranked
        first = np.maximum.accumulate(np.where(new, place, 0))
        rank[ranked] = own + first - start
        tied = ~new
        tied[:-1] |= ~new[1:]
        open_ = ranked[tied]
        depth *= 2
    return order


class Bits:
    """A bit vector with the number of set bits before every 64."""

    def __init__(self, flags: np.ndarray):
        padded = np.zeros(len(flags) // 64 * 64 + 64, bool)
        padded[:len(flags)] = flags
        self.blocks = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        block = places >> 6
        mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.blocks[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) > 0


class WaveletTree:
    """Ranks of symbols: per level one bit of every symbol, in the order that the levels above
    have sorted them into, zeros before ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        for level in reversed(range(bits)):
            ones = (symbols >> level) & 1 > 0
            self.levels.append(Bits(ones))
            self.zeros.append(len(symbols) - int(ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        codes = np.arange(1 << bits) if bits <= 20 else np.unique(symbols)
        begin = np.zeros(len(codes), np.int64)
        #: where each symbol's leaf begins
        self.leaf = np.zeros(1 << bits, np.int64)
        self.leaf[codes] = self._down(codes, begin)

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, vector, zeros in zip(reversed(range(self.bits)), self.levels, self.zeros):
            ones = vector.rank(places)
            places = np.where((symbols >> level) & 1 > 0, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, places) - self.leaf[symbols]

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places, and how often each occurs before."""
        symbols = np.zeros(len(places), np.int64)
        for vector, zeros in zip(self.levels, self.zeros):
            one, ones = vector.at(places), vector.rank(places)
            symbols = symbols * 2 + one
            places = np.where(one, zeros + ones, places - ones)
        return symbols, places - self.leaf[symbols]


class FMIndex:
    """Search in a sequence of codes of which the last is 0, and 0 matches nothing."""

    def __init__(self, codes: np.ndarray, bits: int):
        order = suffix_order(codes, bits)
        self.tree = WaveletTree(codes[order - 1].astype(np.int64), bits)
        #: how many suffixes begin with a smaller symbol
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=1 << bits))])
        sampled = (codes[order] > 0) & ((order % SAMPLE == 0) | (codes[order - 1] == 0))
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the suffixes that begin with each phrase begin and end in their order; rows of
        ``phrases`` are padded behind their length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.smaller[-1], np.int64)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - step]
            if step:
                low[live] = self.smaller[symbol] + self.tree.rank(symbol, low[live])
                high[live] = self.smaller[symbol] + self.tree.rank(symbol, high[live])
            else:
                low[live], high[live] = self.smaller[symbol], self.smaller[symbol + 1]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes with these numbers."""
        out = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            known = self.sampled.at(rows)
            out[open_[known]] = self.positions[self.sampled.rank(rows[known])] + steps
            open_, rows = open_[~known], rows[~known]
            symbol, before = self.tree.at(rows)
            rows = self.smaller[symbol] + before
            steps += 1
        return out


# --- phrases --------------------------------------------------------------------------


@dataclass
class Phrases:
    """Words and windows of some benchmark items; codes begin at 1."""

    codes: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    #: the items of each window, as numbers into ``items``
    items_of: list[list[int]]
    items: list[str]

    @property
    def bits(self) -> int:
        return len(self.codes).bit_length()


def phrases_of(items: list[tuple[str, str]], window: int) -> Phrases:
    """The different windows of (id, text) pairs; a short text is one window, an empty one none."""
    codes: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    names = sorted({name for name, _ in items})
    number = {name: n for n, name in enumerate(names)}
    for name, text in items:
        coded = [codes.setdefault(w, len(codes) + 1) for w in words_of(text)]
        for at in range(max(1, len(coded) - window + 1) if coded else 0):
            found.setdefault(tuple(coded[at:at + window]), set()).add(number[name])
    windows = np.zeros((len(found), window), np.int64)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    for row, phrase in enumerate(found):
        windows[row, :len(phrase)] = phrase
    return Phrases(codes, windows, lengths, [sorted(x) for x in found.values()], names)


def occurrences(coded: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, place) of every occurrence in a sequence that ends with 0."""
    index = FMIndex(coded, phrases.bits)
    low, high = index.ranges(phrases.windows, phrases.lengths)
    sizes = high - low
    window = np.repeat(np.arange(len(sizes)), sizes)
    rows = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return window, index.locate(rows)


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.append(True, begins[1:] > reach[:-1])[:len(begins)]
    return begins[new], reach[np.append(new[1:], True)[:len(begins)]]


class Shard:
    """Coded words of several documents, each followed by a 0."""

    def __init__(self, phrases: Phrases, window: int):
        self.phrases, self.window = phrases, window
        self.parts: list[np.ndarray] = []
        #: document and first word of each part
        self.docs: list[int] = []
        self.offsets: list[int] = []
        self.size = 0

    def add(self, doc: int, words: list[bytes]) -> None:
        coded = np.zeros(len(words) + 1, np.int32)
        coded[:-1] = np.fromiter(
            map(self.phrases.codes.get, words, repeat(0)), np.int32, len(words))
        step = SHARD_WORDS - self.window + 1
        for at in range(0, max(1, len(words) - self.window + 1), step):
            part = coded[at:at + SHARD_WORDS]
            self.parts.append(part if part[-1] == 0 else np.append(part, np.int32(0)))
            self.docs.append(doc)
            self.offsets.append(at)
            self.size += len(self.parts[-1])

    def hits(self) -> dict[int, tuple[np.ndarray, np.ndarray, set[int]]]:
        """Per document with occurrences: begins and ends of its spans, and items."""
        starts = np.cumsum([0] + [len(p) for p in self.parts])
        window, place = occurrences(np.concatenate(self.parts), self.phrases)
        part = np.searchsorted(starts, place, side="right") - 1
        doc = np.array(self.docs)[part]
        begin = place - starts[part] + np.array(self.offsets)[part]
        end = begin + self.phrases.lengths[window]
        out = {}
        order = np.argsort(doc, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
            if len(group):
                items = {i for w in np.unique(window[group]) for i in self.phrases.items_of[w]}
                out[int(doc[group[0]])] = (*merged(begin[group], end[group]), items)
        return out


# --- Spark ----------------------------------------------------------------------------

FOUND = "n_words long, spans array<struct<begin: int, end: int>>, items array<string>"


def find_phrases(docs: DataFrame, phrases: Phrases, window: int) -> DataFrame:
    """Columns of ``docs`` but ``text``, then FOUND."""
    prepare(docs.sparkSession)
    extra = StructType.fromDDL(FOUND)
    others = other_columns(docs, extra.names)
    schema = StructType([docs.schema[c] for c in others] + extra.fields)
    shared = docs.sparkSession.sparkContext.broadcast(phrases)  # of at most BLOCK_BYTES of texts
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        held: list[pa.RecordBatch] = []
        sizes: list[int] = []
        shard = Shard(phrases, window)

        def done() -> Iterator[pa.RecordBatch]:
            found = shard.hits() if len(phrases.lengths) else {}
            spans = [[] for _ in sizes]
            items = [[] for _ in sizes]
            for doc, (begins, ends, numbers) in found.items():
                spans[doc] = [
                    {"begin": b, "end": e} for b, e in zip(begins.tolist(), ends.tolist())]
                items[doc] = [phrases.items[i] for i in sorted(numbers)]
            columns = {
                "n_words": pa.array(sizes, pa.int64()),
                "spans": pa.array(spans, pa.list_(span)),
                "items": pa.array(items, pa.list_(pa.string()))}
            at = 0
            for batch in held:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(c.slice(at, batch.num_rows) for c in columns.values())],
                    [*others, *columns])
                at += batch.num_rows

        for batch in batches:
            texts, begin = batch.column("text"), 0
            rest = batch.select(others)
            for n, text in enumerate(texts):
                words = words_of(text.as_py())
                shard.add(len(sizes), words)
                sizes.append(len(words))
                if shard.size >= SHARD_WORDS:
                    held.append(rest.slice(begin, n + 1 - begin))
                    yield from done()
                    held, sizes, shard, begin = [], [], Shard(phrases, window), n + 1
            if begin < batch.num_rows:
                held.append(rest.slice(begin))
        if sizes:
            yield from done()

    return docs.select(*others, text_or_empty()).mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``n_words``, ``spans`` and ``items``.

    ``spans`` are maximal runs of words, as (begin, end) word numbers, that lie in occurrences of
    any ``window`` consecutive words of a benchmark text, or of a whole shorter text; spans that
    touch are one. ``items`` are the ids of those texts, as strings in order. Null texts have no
    words; a null item id counts as the empty string; items with equal ids are one.
    """
    named = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_or_empty())
    size = named.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    n_blocks = size // block_bytes + 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))

    def phrases(number: int) -> Phrases:
        rows = named.filter(block == number).distinct().collect()
        return phrases_of([(r["item"], r["text"]) for r in rows], window)

    if n_blocks == 1:
        return find_phrases(docs, phrases(0), window)
    # several passes, so the rows need a name that every pass gives them
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "contaminated")
    first, found = None, None
    for number in range(n_blocks):
        part = stored(find_phrases(keyed, phrases(number), window), "phrases")
        first = part if first is None else first
        hits = part.filter("size(spans) > 0").select("_row", "spans", "items")
        found = hits if found is None else found.unionByName(hits)
    # one row per block and document at most
    sums = found.groupBy("_row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    kinds = {c: first.schema[c].dataType.simpleString() for c in ("spans", "items")}
    joined = first.drop("spans", "items").join(sums, "_row", "left").withColumns({
        c: F.coalesce(c, F.array().cast(kind)) for c, kind in kinds.items()})
    return joined.drop("_row").withColumn("spans", merged_column("spans"))


def merged_column(spans: str):
    """A column of spans as maximal runs."""
    kind = "array<struct<begin: int, end: int>>"
    last = "element_at(done, -1)"
    return F.expr(f"""aggregate(array_sort({spans}), cast(array() as {kind}), (done, s) ->
        if(size(done) > 0 and s.begin <= {last}.end,
           concat(slice(done, 1, size(done) - 1), array(struct({last}.begin as begin,
                  greatest({last}.end, s.end) as end))),
           concat(done, array(s))))""")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs``; words in benchmark passages are cut from ``text``, with
    what stands between them. A null text stays null."""
    # the row as a whole, so that no column of it clashes with a found one
    marked = contamination(
        docs.select(F.struct(*docs.columns).alias("_doc"), "text"), benchmark, window)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, texts = batch.column("_doc"), []
            columns = dict(zip(names, row.flatten()))
            for text, spans in zip(
                    columns["text"].to_pylist(), batch.column("spans").to_pylist()):
                if spans:
                    words = [m.span() for m in WORD.finditer(text)]
                    at, parts = 0, []
                    for s in spans:
                        parts.append(text[at:words[s["begin"]][0]])
                        at = words[s["end"] - 1][1]
                    text = "".join(parts) + text[at:]
                texts.append(text)
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return marked.mapInArrow(run, docs.schema)


def op11_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Which words of every document are in passages of the benchmark, and of which items."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, folder, "benchmark").select("item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


ORACLE = r"""
WITH folded AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
cut AS (
  SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos
  FROM item WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(words[pos:pos + 9], ' ') AS phrase
  FROM cut),
sizes AS (SELECT DISTINCT size FROM windows),
placed AS (
  SELECT row, size, words, unnest(range(1, len(words) - size + 2)) AS pos
  FROM folded JOIN sizes ON len(words) >= size),
held AS (
  SELECT row, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS phrase FROM placed),
found AS (SELECT row, size, pos, item FROM held JOIN windows USING (size, phrase)),
hit AS (SELECT row, count(DISTINCT word) AS n_hit FROM (
  SELECT row, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items
  FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM folded LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""
