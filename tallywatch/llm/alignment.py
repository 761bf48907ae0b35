"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers cover the same bytes, so their tokens are two rising lists of byte ends. A task
lays the ends of many texts one after the other and merges both lists along the merge path:
diagonals at equal distances are searched by bisection, all at once, and cut the path into
pieces of equal work, whatever the lengths of texts and tokens. The pieces are merged side by
side, one step of every piece at a time. Each step ends one token; the two tokens current then
overlap, unless the other list has just ended at the same byte, which closes a group. A piece
numbers its groups by itself; the last group of a piece goes on in the next one, so running
sums over the pieces stitch the numbers together.

Texts are cut for encoding at single spaces between other characters, which no token of either
vocabulary crosses, and every different unit is encoded once per worker. How many texts hold
an id pair is counted over all rows: the most frequent pairs, as many as have a fixed bound,
are broadcast, all others are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.common import (
    map_batches,
    other_columns,
    prepare,
    replace_columns,
    table,
    text_or_empty,
)
from tallywatch.session import fresh_path

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE = 128
"""Ends that one piece of the merge path takes."""
CHUNK = 3_000_000
"""Characters that are merged together; a longer text is merged alone."""
KNOWN_UNITS = 800_000
"""Units a worker remembers before it forgets them; only speed depends on it."""
HEAD_PAIRS = 1 << 20
"""Most id pairs whose counts are broadcast; the others are joined."""
COUNTED_PAIRS = 1 << 21
"""Different id pairs after which a task hands on its counts."""

# Not white space for every splitter, so no text is cut beside them.
DOUBTFUL = "\u180e\u200b\ufeff\u2581\0"
CUT = re.compile(rf"(?<=[^\s{DOUBTFUL}]) (?=[^\s{DOUBTFUL}])")


# --- merge path -----------------------------------------------------------------------


def diagonal_cuts(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first ``d`` merged ends, for each diagonal ``d``; of
    equal ends that of ``a`` comes first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        further = a[middle] <= b[diagonals[open_] - 1 - middle]
        low[open_[further]] = middle[further] + 1
        high[open_[~further]] = middle[~further]
    return low


@dataclass
class Merged:
    """One entry per step of the path: the tokens current there, whether they overlap, whether
    the step ends a token of ``a``, and the number of its group."""

    a: np.ndarray
    b: np.ndarray
    overlaps: np.ndarray
    from_a: np.ndarray
    group: np.ndarray
    n_groups: int


def merge_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Merged:
    """Merge two strictly rising lists of ends that have the same last end."""
    total = len(a) + len(b)
    cuts = np.append(np.arange(0, total, piece), total)
    in_a = diagonal_cuts(a, b, cuts)
    at, last = cuts[:-1], np.iinfo(np.int64).max
    i, j = in_a[:-1].copy(), at - in_a[:-1]
    a, b = np.append(a, last), np.append(b, last)
    # an index of -1 reads the sentinel; there is no end before the first one
    before = np.maximum(np.where(i > 0, a[i - 1], 0), np.where(j > 0, b[j - 1], 0))
    closed = np.zeros(len(at), np.int64)
    out = Merged(*(np.empty(total, t) for t in (np.int32, np.int32, bool, bool, np.int64)), 0)
    for step in range(min(piece, total)):
        if at[-1] + step >= total:  # only the last piece can be short
            at, i, j, before = at[:-1], i[:-1], j[:-1], before[:-1]
            if not len(at):
                break
        place, x, y = at + step, a[i], b[j]
        from_a, end = x <= y, np.minimum(x, y)
        out.a[place], out.b[place], out.from_a[place] = i, j, from_a
        out.group[place] = closed[:len(at)]
        out.overlaps[place] = end > before
        closed[:len(at)] += end == before
        i += from_a
        j += ~from_a
        before = end
    # stitch: the open group at the end of a piece is the first one of the next
    base = np.cumsum(closed) - closed
    out.group += np.repeat(base, np.diff(cuts))
    out.n_groups = int(closed.sum())
    return out


# --- tokens ---------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the units known so far.

    Ids of a unit are slices of flat arrays, so a text's ids are gathered without a loop over
    its tokens.
    """

    def __init__(self, json_text: str, model: bytes):
        # one core per task; read when the library first encodes
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_text)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_letters()
        added = {t["id"]: t["content"] for t in json.loads(json_text).get("added_tokens", ())}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = added[i].encode() if i in added else bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (
            np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        #: whether a space can only begin a piece, so that texts may be cut before spaces
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, int] = {}
        self.good, self.clean = np.empty(0, bool), np.empty(0, bool)
        self.uses = np.empty(0, np.int64)
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        #: where each unit's ids begin, and where the last one's end
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def numbers(self, split: list[list[str]]) -> np.ndarray:
        """The numbers of all units of the texts, one text after the other; new units are
        learned. Earlier numbers do not hold any more."""
        new = set(chain.from_iterable(split)).difference(self.known)
        if len(self.known) + len(new) > KNOWN_UNITS and self.known:
            self.forget_rare()
            new = set(chain.from_iterable(split)).difference(self.known)
        if new:
            self.learn(list(new))
        found = np.fromiter(
            map(self.known.__getitem__, chain.from_iterable(split)), np.int64,
            sum(map(len, split)))
        self.uses += np.bincount(found, minlength=len(self.uses))
        return found

    def forget_rare(self) -> None:
        """Keep the more frequent half."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:KNOWN_UNITS // 2])
        names = list(self.known)
        self.known = {names[i]: n for n, i in enumerate(kept.tolist())}
        self.good, self.clean = self.good[kept], self.clean[kept]
        self.uses = self.uses[kept] // 2
        for side in range(2):
            self.ids[side], sizes = gather(self.ids[side], self.starts[side], kept)
            self.starts[side] = np.concatenate([[0], np.cumsum(sizes)])

    def learn(self, units: list[str]) -> None:
        """Ids of new units, whether both lists of tokens give back the unit's bytes, and
        whether the unit is free of odd characters at its ends."""
        encoded = [e.ids for e in self.a.encode_batch_fast(
            [" " + u for u in units], add_special_tokens=False)]
        pieces = self.b.encode(units, num_threads=1)
        raw = [b" " + u.encode() for u in units]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        good = np.ones(len(units), bool)
        for side, new, vocabulary, lengths in (
                (0, encoded, self.bytes_a, self.length_a), (1, pieces, self.bytes_b, self.length_b)):
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            flat = np.fromiter(chain.from_iterable(new), np.int32, int(sizes.sum()))
            ends = np.cumsum(sizes)
            covered = np.concatenate([[0], np.cumsum(lengths[flat])])
            same = covered[ends] - covered[ends - sizes] == length
            if not (same.all() and b"".join(map(vocabulary.__getitem__, flat)) == b"".join(raw)):
                same = [b"".join(map(vocabulary.__getitem__, x)) == r for x, r in zip(new, raw)]
            good &= same
            self.ids[side] = np.append(self.ids[side], flat)
            self.starts[side] = np.append(self.starts[side], self.starts[side][-1] + ends)
        clean = [u != "" and u[0] not in DOUBTFUL and u[-1] not in DOUBTFUL and u == u.strip()
                 for u in units]
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))
        self.good, self.clean = np.append(self.good, good), np.append(self.clean, clean)
        self.uses = np.append(self.uses, np.zeros(len(units), np.int64))


def gather(flat: np.ndarray, starts: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the units on end, and how many each unit has."""
    sizes = starts[units + 1] - starts[units]
    begin = np.cumsum(sizes) - sizes
    where = np.repeat(starts[units] - begin, sizes) + np.arange(int(sizes.sum()))
    return flat[where], sizes


@dataclass
class Aligned:
    """Tokens of several texts and how they align; ``merged`` numbers tokens over all texts."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    merged: Merged

    def group_sizes(self) -> tuple[np.ndarray, np.ndarray]:
        m = self.merged
        return (np.bincount(m.group[m.from_a], minlength=m.n_groups),
                np.bincount(m.group[~m.from_a], minlength=m.n_groups))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, A token, B token) of every overlap, in order."""
        at = np.flatnonzero(self.merged.overlaps)
        a = self.merged.a[at]
        return np.repeat(np.arange(len(self.n_a)), self.n_a)[a], a, self.merged.b[at]

    def groups_of_texts(self) -> np.ndarray:
        """How many groups each text has."""
        m = self.merged
        text = np.repeat(np.arange(len(self.n_a)), self.n_a)[m.a[m.from_a]]
        first = np.diff(m.group[m.from_a], prepend=-1) > 0
        return np.bincount(text[first], minlength=len(self.n_a))


def align(known: Tokenizers, texts: list[str]) -> Aligned:
    """Align the tokens of the texts. Texts that either tokenizer does not give back byte for
    byte have no tokens, and neither have empty ones."""
    # cut at every space; again, with more care, where a unit then has an odd end
    split = [(t.split(" ") if known.cuts else [t]) if t else [] for t in texts]
    units = known.numbers(split)
    of_text = np.repeat(np.arange(len(texts)), [len(us) for us in split])
    odd = np.unique(of_text[~known.clean[units]]) if known.cuts else []
    if len(odd):
        for i in odd:
            split[i] = CUT.split(texts[i])
        units = known.numbers(split)
        of_text = np.repeat(np.arange(len(texts)), [len(us) for us in split])
    bad = np.bincount(of_text[~known.good[units]], minlength=len(texts)) > 0
    keep = ~bad[of_text]
    units, of_text = units[keep], of_text[keep]
    (a, size_a), (b, size_b) = (
        gather(*x, units) for x in zip(known.ids, known.starts))
    n_a, n_b = (
        np.bincount(of_text, weights=s, minlength=len(texts)).astype(np.int64)
        for s in (size_a, size_b))
    merged = merge_ends(np.cumsum(known.length_a[a]), np.cumsum(known.length_b[b]))
    return Aligned(a, b, n_a, n_b, merged)


# --- Spark ----------------------------------------------------------------------------

_workers: dict[int, Tokenizers] = {}


def worker_tokenizers(files: tuple[str, bytes]) -> Tokenizers:
    """The worker's own tokenizers and units, kept from task to task."""
    key = hash(files)
    if key not in _workers:
        _workers.clear()
        _workers[key] = Tokenizers(*files)
    return _workers[key]


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about CHUNK characters."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > CHUNK:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _aligned(docs: DataFrame, a_path: str, b_path: str, added: str,
             finish: Callable[[Aligned, Tokenizers], dict[str, pa.Array]]) -> DataFrame:
    """Columns of ``docs`` but ``text``, then what ``finish`` makes of aligned texts. Columns
    with the name of an added one are replaced."""
    files = docs.sparkSession.sparkContext.broadcast(  # two vocabularies, a few MB
        (Path(a_path).read_text(encoding="utf-8"), Path(b_path).read_bytes()))
    extra = StructType.fromDDL(added)
    others = other_columns(docs, extra.names)
    schema = StructType([docs.schema[c] for c in others] + extra.fields)

    def make():
        known = worker_tokenizers(files.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [finish(align(known, part), known)
                     for part in chunks([t or "" for t in batch.column("text").to_pylist()])]
            return replace_columns(batch, ["text"], **{
                n: pa.concat_arrays([p[n] for p in parts]) for n in extra.names})

        return step

    return map_batches(docs.select(*others, text_or_empty()), make, schema)


def lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``groups`` and ``links``.

    A group holds the ids of A and of B between two neighbouring byte offsets at which tokens
    of both end; a link the places (from 0) of an A and a B token that share bytes. Null and
    empty texts, and those that a tokenizer does not give back byte for byte, have neither.
    """

    def finish(found: Aligned, known: Tokenizers) -> dict[str, pa.Array]:
        sizes = found.group_sizes()
        groups = pa.StructArray.from_arrays(
            [lists(pa.array(x), s) for x, s in zip((found.a, found.b), sizes)], ["a", "b"])
        text, a, b = found.links()
        first_a, first_b = np.cumsum(found.n_a) - found.n_a, np.cumsum(found.n_b) - found.n_b
        links = pa.StructArray.from_arrays(
            [pa.array((x - f[text]).astype(np.int32)) for x, f in ((a, first_a), (b, first_b))],
            ["a", "b"])
        return {"groups": lists(groups, found.groups_of_texts()),
                "links": lists(links, np.bincount(text, minlength=len(found.n_a)))}

    return _aligned(
        docs, a_path, b_path,
        "groups array<struct<a: array<int>, b: array<int>>>, links array<struct<a: int, b: int>>",
        finish)


def packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Each text's rising keys as differences, byte planes apart, which compress well."""
    cuts = np.cumsum(sizes)
    return pa.array([
        np.diff(v, prepend=np.int64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
        for v in np.split(values, cuts[:-1])], pa.binary())


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all rows on end, and how many each row has."""
    parts = [
        np.cumsum(np.ascontiguousarray(
            np.frombuffer(v, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64))
        for v in column.to_pylist()]
    return (np.concatenate([*parts, np.empty(0, np.int64)]),
            np.fromiter(map(len, parts), np.int64, len(parts)))


DIGESTS = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs binary, times binary")


def digest_alignments(docs: DataFrame, a_path: str, b_path: str, n_b_ids: int) -> DataFrame:
    """Columns of ``docs`` but ``text``, then DIGESTS: counts, the SHA-256 of the groups written
    as text, and the different id pairs (A id times ``n_b_ids`` plus B id, rising, packed) with
    how often each is linked."""

    def finish(found: Aligned, known: Tokenizers) -> dict[str, pa.Array]:
        written = [
            pc.binary_join(lists(pa.array(x).cast(pa.string()), s), ",")
            for x, s in zip((found.a, found.b), found.group_sizes())]
        n_groups = found.groups_of_texts()
        groups = pc.binary_join(
            lists(pc.binary_join_element_wise(*written, "|"), n_groups), ";").to_pylist()
        text, a, b = found.links()
        key = found.a[a].astype(np.int64) * n_b_ids + found.b[b]
        span = int(key.max(initial=0)) + 1
        both, times = np.unique(text * span + key, return_counts=True)
        text_of_pair = both // span
        sizes = np.bincount(text_of_pair, minlength=len(found.n_a))
        cuts = np.cumsum(sizes)[:-1]
        return {
            "n_a": pa.array(found.n_a), "n_b": pa.array(found.n_b),
            "n_groups": pa.array(n_groups.astype(np.int64)),
            "n_links": pa.array(np.bincount(text, minlength=len(found.n_a)).astype(np.int64)),
            "groups_sha256": pa.array(
                [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
            "pairs": packed(both - text_of_pair * span, sizes),
            "times": pa.array(
                [t.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                 for t in np.split(times, cuts)], pa.binary()),
        }

    return _aligned(docs, a_path, b_path, DIGESTS, finish)


def times_of(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(
        np.ascontiguousarray(np.frombuffer(v, np.uint8).reshape(4, -1).T).view("<u4").ravel()
        .astype(np.int64) for v in column.to_pylist())])


def count_pairs(digests: DataFrame) -> DataFrame:
    """(pair, n): how many rows hold each pair linked. Tasks add up first."""
    prepare(digests.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def add() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate([np.empty(0, np.int64), *waiting]),
                               return_counts=True)
            both, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
            return both, np.bincount(where, np.concatenate([counts, n])).astype(np.int64)

        for batch in batches:
            waiting.append(unpacked(batch.column("pairs"))[0])
            size += len(waiting[-1])
            if size >= COUNTED_PAIRS:
                keys, counts = add()
                waiting, size = [], 0
            if len(keys) >= COUNTED_PAIRS:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(counts)], ["pair", "n"])
                keys, counts = keys[:0], counts[:0]
        keys, counts = add()
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])

    found = digests.select("pairs").mapInArrow(run, "pair long, n long")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def head_of(counts: DataFrame, most: int) -> DataFrame:
    """The rows with ``n`` above a bound that at most ``most`` rows exceed: whole steps of a
    logarithmic scale, of which there are a few hundred."""
    step = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    lowest, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        lowest = row["step"]
    return counts.filter(F.lit(False) if lowest is None else step >= lowest)


def score_head(digests: DataFrame, counts: DataFrame, n_b_ids: int,
               head_pairs: int) -> tuple[DataFrame, DataFrame]:
    """The digests without packed columns, then ``n_best`` and ``count_sum`` over the links whose
    pair is among the at most ``head_pairs`` most frequent ones, and the other pairs as ``rest``;
    and (pair, n, is_best) of all pairs.

    ``is_best``: no pair with the same A id has a higher count.
    """
    # one row per id of A: bounded by its vocabulary
    best = counts.groupBy(F.floor(F.col("pair") / n_b_ids).alias("a")).agg(F.max("n").alias("top"))
    rated = counts.join(
        F.broadcast(best), F.floor(counts["pair"] / n_b_ids) == best["a"]).select(
        "pair", "n", (F.col("n") == F.col("top")).alias("is_best"))
    head_table = head_of(rated, head_pairs).toArrow()
    keys = head_table["pair"].to_numpy()
    order = np.argsort(keys)
    shared = digests.sparkSession.sparkContext.broadcast((
        keys[order], head_table["n"].to_numpy()[order],
        head_table["is_best"].to_numpy()[order].astype(np.int64)))
    others = [c for c in digests.columns if c not in ("pairs", "times")]
    rest_type = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))

    def make():
        keys, n, best = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs, sizes = unpacked(batch.column("pairs"))
            times = times_of(batch.column("times"))
            row = np.repeat(np.arange(len(sizes)), sizes)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                hit = keys[at] == pairs
            else:
                at, hit = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
            found, rows, often = at[hit], row[hit], times[hit]
            sums = np.zeros((2, len(sizes)), np.int64)
            np.add.at(sums[0], rows, often * best[found])
            np.add.at(sums[1], rows, often * n[found])
            rest = pa.StructArray.from_arrays(
                [pa.array(pairs[~hit]), pa.array(times[~hit])], ["pair", "times"])
            return replace_columns(
                batch, ["pairs", "times"], n_best=pa.array(sums[0]), count_sum=pa.array(sums[1]),
                rest=lists(rest, np.bincount(row[~hit], minlength=len(sizes))).cast(rest_type))

        return step

    schema = StructType(
        [digests.schema[c] for c in others]
        + StructType.fromDDL(
            "n_best long, count_sum long, rest array<struct<pair: long, times: long>>").fields)
    scored = map_batches(digests, make, schema)
    return scored, rated


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How both tokenizers' tokens align in every document.

    Null, empty and not faithfully encoded texts have zeros and an empty digest; repeated rows
    count as documents each, as do rows without id; an empty table gives an empty result.
    """
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return alignment_scores(
        docs, public_tokenizers.path(FILE_A), public_tokenizers.path(FILE_B))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def alignment_scores(
    docs: DataFrame, a_path: str, b_path: str, head_pairs: int = HEAD_PAIRS
) -> DataFrame:
    """Columns of ``docs`` but ``text``, then the digests, ``n_best`` and ``count_sum``."""
    import sentencepiece

    n_b_ids = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    keyed = docs.withColumn("_alignment_row", F.monotonically_increasing_id())
    digests = _stored(digest_alignments(keyed, a_path, b_path, n_b_ids), "alignments")
    counts = _stored(count_pairs(digests), "pair_counts")
    scored, rated = score_head(digests, counts, n_b_ids, head_pairs)
    scored = _stored(scored, "scored_links")
    rest = scored.filter("size(rest) > 0").select("_alignment_row", F.inline("rest"))
    added = rest.join(rated, "pair").groupBy("_alignment_row").agg(
        F.sum(F.col("times") * F.col("is_best").cast("long")).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    whole = scored.drop("rest").join(added, "_alignment_row", "left")
    return whole.select(
        *[c for c in scored.columns if c not in ("_alignment_row", "rest", "n_best", "count_sum")],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))
