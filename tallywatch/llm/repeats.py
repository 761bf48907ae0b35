"""Repeated byte strings across documents, by suffix arrays over candidate regions.

Every string of ``LENGTH`` bytes holds a smallest hashed gram, which any copy of it holds at
the same place. So a string can only be repeated if its smallest gram's hash, its mark,
occurs at two places. The starts that share a mark lie in runs; the text of a run is a
context. Contexts with equal marks are compared by a suffix array built in two stages: the
suffixes smaller than their successors are sorted directly, all others are induced by one
scan over the buckets of first bytes. Neighbours in the array whose common prefix reaches
``LENGTH`` are repeats. Everything is exact; marks only say what has to be compared.

Equal texts, and equal contexts, are compared once. A mark that very many different contexts
share is compared string by string instead, so no task holds all of its contexts.

Passages of ``PASSAGE_WORDS`` equal words go the same way: their marks are the smallest hashed
word grams, and their suffix arrays hold one number for each word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm.common import (
    map_batches, mix64, prepare, remove_stored, stored, table, text_or_empty, window_hashes,
)

LENGTH = 400
GRAM = 64
PASSAGE_WORDS = 51
"""Words of the shortest repeated passage, whatever its bytes."""
GRAM_WORDS = 12
WORD_BYTES = 4
"""Bytes of a word's number in a suffix array of words."""
BLOCK_BYTES = 400_000
"""Context bytes of one suffix array; a mark is never cut, so one mark may exceed it."""
HOT_BYTES = 6_000_000
"""Bytes of a mark's different contexts beyond which strings are compared one by one."""
SORT_AT_ONCE = 50_000
"""Suffixes beyond which equal sort keys share their memory."""
SEPARATOR = b"\xff"
"""Occurs in no UTF-8 text."""

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of them."""
    if len(_powers.get("up", ())) < max(n, 1):
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def prefix_sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the weighted bytes before each place, and the factors that undo the weights."""
    up, down = _power_table(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=sums[1:])
    return sums, down


def word_edges(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    space = np.ones(len(codes) + 2, np.int8)
    space[1:-1] = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edges = np.flatnonzero(np.diff(space))
    return edges[::2], edges[1::2]


def sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive values, by block prefixes and
    suffixes."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, fill, values.dtype)
    padded[:len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = pick.accumulate(padded, axis=1).ravel()
    behind = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n], ahead[width - 1:width - 1 + n])


def least_runs(hashes: np.ndarray, width: int):
    """(mark, first window, end of windows, several) of the runs of windows of ``width`` hashes
    that share their smallest one.

    ``several``: the smallest gram occurs more than once in the text, so that strings of one
    run may repeat each other.
    """
    least = sliding(hashes, width, np.minimum, int(np.iinfo(np.uint64).max))
    begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    end = np.append(begin[1:], len(least))
    # a gram is smallest somewhere if the largest minimum of the windows around it is its own
    edged = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    chosen = hashes[sliding(edged, width, np.maximum, 0)[:len(hashes)] == hashes]
    found, times = np.unique(chosen, return_counts=True)
    marks = least[begin]
    return marks, begin, end, np.isin(marks, found[times > 1])


def marked_runs(raw: bytes, length: int = LENGTH, words: int = 0):
    """(mark, begin, end, several) of the contexts of a text, in bytes.

    The lowest bit of a mark is set for contexts of passages of so many ``words``.
    """
    codes = np.frombuffer(raw, np.uint8)
    sums, down = prefix_sums(codes)
    parts = [(np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2, np.empty(0, bool))]
    if len(raw) >= length:
        n = len(codes) - GRAM + 1
        grams = mix64((sums[GRAM:] - sums[:n]) * down[:n])
        marks, begin, end, several = least_runs(grams, length - GRAM + 1)
        parts.append((marks & ~np.uint64(1), begin, end + length - 1, several))
    if words:
        first, last = word_edges(codes)
        if len(first) >= words:
            grams = window_hashes(mix64((sums[last] - sums[first]) * down[first]), GRAM_WORDS)
            marks, begin, end, several = least_runs(grams, words - GRAM_WORDS + 1)
            parts.append((marks | np.uint64(1), first[begin], last[end + words - 2], several))
    return tuple(map(np.concatenate, zip(*parts)))


# --- suffix arrays --------------------------------------------------------------------


def smaller_than_next(codes: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one counts as smaller."""
    step = np.sign(np.diff(codes.astype(np.int16)))
    places = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(places[::-1])[::-1]
    return np.append(np.append(step, 1)[following] > 0, True)


def directly_sorted(text: bytes, codes: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes. Those that agree in the first two
    bytes are sorted at a time, so the keys of only these are held."""
    pair = codes[at].astype(np.int32) * 256 + codes[np.minimum(at + 1, len(codes) - 1)]
    ranked = at[np.argsort(pair, kind="stable")]
    cuts = np.flatnonzero(np.diff(np.sort(pair))) + 1
    out = []
    for part in np.split(ranked, cuts):
        places = part.tolist()
        if len(places) > SORT_AT_ONCE:
            shared: dict[bytes, bytes] = {}
            keys = {i: shared.setdefault(text[i:i + depth], text[i:i + depth]) for i in places}
        else:
            keys = {i: text[i:i + depth] for i in places}
        places.sort(key=keys.__getitem__)
        out += places
    return np.array(out, np.int64)


def two_stage_order(text: bytes, codes: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes in the order of their first ``depth`` bytes.

    Directly sorted are the suffixes that are smaller than their successors. The others
    are induced: scanning the buckets of first bytes upwards, the predecessor of each suffix
    takes the next free place of its bucket, in front of the directly sorted ones. Runs of
    one byte stay in their bucket and are followed in waves.
    """
    small = smaller_than_next(codes)
    # from a wanted suffix to the next directly sorted one, all are needed
    used = wanted.copy()
    tails = np.flatnonzero(wanted[:-1] & ~wanted[1:] & ~small[:-1])
    for at in tails + 1:
        while True:
            used[at] = True
            if small[at]:
                break
            at += 1
    direct = directly_sorted(text, codes, np.flatnonzero(used & small), depth)
    first = codes[direct]
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def scan(part: np.ndarray, bucket: int) -> np.ndarray:
        """Place the larger predecessors; those of this same bucket are returned."""
        out.append(part)
        before = part[part > 0] - 1
        before = before[used[before] & ~small[before]]
        byte = codes[before]
        ranked = np.argsort(byte, kind="stable")
        before, byte = before[ranked], byte[ranked]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        same = before[:0]
        for group in np.split(before, cuts):
            if len(group):
                code = int(codes[group[0]])
                if code == bucket:
                    same = group
                else:
                    induced[code].append(group)
        return same

    for bucket in range(256):
        wave = np.concatenate(induced[bucket]) if induced[bucket] else np.empty(0, np.int64)
        while len(wave):
            wave = scan(wave, bucket)
        begin, end = np.searchsorted(first, [bucket, bucket + 1])
        if end > begin:
            scan(direct[begin:end], bucket)
    ranked = np.concatenate(out) if out else np.empty(0, np.int64)
    return ranked[wanted[ranked]]


def prefixes_reach(text: bytes, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of each pair of suffixes has ``length`` bytes, eight by eight."""
    eights = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    alive = np.arange(len(left))
    offsets = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for offset in offsets:
        alive = alive[eights[left[alive] + offset] == eights[right[alive] + offset]]
        if not len(alive):
            break
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def repeated_starts(
    contexts: list[bytes], length: int = LENGTH, step: int = 1,
) -> list[np.ndarray]:
    """For each context, which of its starts begin a string that another start begins too.
    Strings start at every ``step``-th byte."""
    text = SEPARATOR.join(contexts) + SEPARATOR
    codes = np.frombuffer(text, np.uint8)
    offsets = np.cumsum([0] + [len(c) + 1 for c in contexts[:-1]])
    wanted = np.zeros(len(codes), bool)
    for offset, context in zip(offsets, contexts):
        wanted[offset:offset + len(context) - length + 1:step] = True
    order = two_stage_order(text, codes, wanted, length)
    equal = prefixes_reach(text, order[:-1], order[1:], length)
    repeated = np.zeros(len(codes), bool)
    repeated[order[:-1][equal]] = True
    repeated[order[1:][equal]] = True
    return [repeated[o:o + len(c) - length + 1:step] for o, c in zip(offsets, contexts)]


def repeated_passages(contexts: list[bytes], words: int) -> list[np.ndarray]:
    """For each context, which of its words begin ``words`` words that stand elsewhere too."""
    numbers: dict[bytes, int] = {}
    coded = [
        np.array([numbers.setdefault(w, len(numbers)) for w in context.split()], "<u4").tobytes()
        for context in contexts]
    return repeated_starts(coded, words * WORD_BYTES, WORD_BYTES)


def windows(context: bytes, mark: int, length: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every string of a context that is compared."""
    if mark & 1:
        first, last = word_edges(np.frombuffer(context, np.uint8))
        return first[:len(first) - words + 1], last[words - 1:]
    first = np.arange(len(context) - length + 1)
    return first, first + length


def runs_of(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Begins and ends of the runs of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2].tolist(), edges[1::2].tolist()


# --- Spark ----------------------------------------------------------------------------


def text_marks(keyed: DataFrame, length: int, words: int) -> DataFrame:
    """(text_key, n_bytes, sha256, runs) of each row; runs are (mark, begin, end, several)."""
    run = pa.list_(pa.struct([
        ("mark", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("several", pa.bool_())]))
    others = [c for c in keyed.columns if c != "text"]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, digests, runs = [], [], []
            for value in batch.column("text").to_pylist():
                raw = value.encode()
                marks, begin, end, several = marked_runs(raw, length, words)
                sizes.append(len(raw))
                digests.append(hashlib.sha256(raw).hexdigest())
                runs.append(pa.StructArray.from_arrays([
                    pa.array(marks.view(np.int64)), pa.array(begin.astype(np.int32)),
                    pa.array(end.astype(np.int32)), pa.array(several),
                ], fields=list(run.value_type)))
            ends = np.cumsum([0] + [len(r) for r in runs])
            listed = pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.concat_arrays(runs), type=run)
            columns = [batch.column(c) for c in others]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(digests), listed],
                [*others, "n_bytes", "sha256", "runs"])

        return step

    schema = ", ".join([f"`{c}` {keyed.schema[c].dataType.simpleString()}" for c in others] + [
        "n_bytes long, sha256 string",
        "runs array<struct<mark: bigint, begin: int, end: int, several: boolean>>"])
    return map_batches(keyed, make, schema)


def text_key() -> Column:
    """What equal texts share, as bytes: most shuffled rows are little else than this key."""
    return F.unhex(F.md5("text")).alias("text_key")


def cut_contexts(texts: DataFrame) -> DataFrame:
    """(mark, context_key, context, text_key, begin) from (text_key, text, runs)."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for key, text, runs in zip(*(
                    batch.column(c).to_pylist() for c in ("text_key", "text", "runs"))):
                raw = text.encode()
                for r in runs:
                    context = raw[r["begin"]:r["end"]]
                    rows.append((r["mark"], hashlib.md5(context).digest(), context, key, r["begin"]))
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
            columns = list(zip(*rows)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["mark", "context_key", "context", "text_key", "begin"])

        return step

    return map_batches(texts, make, (
        "mark long, context_key binary, context binary, text_key binary, begin int"))


FLAGGED = "mark long, context_key binary, starts array<int>, ends array<int>"


def compare_contexts(contexts: DataFrame, length: int, words: int) -> DataFrame:
    """(mark, context_key, starts, ends): runs of repeated strings in each context, in bytes.

    ``contexts`` has one row (mark, context_key, context, n) per different context; all of a
    mark are in one task, which takes blocks of whole marks.
    """
    prepare(contexts.sparkSession)

    def flag(block: list[list[tuple]]) -> Iterator[tuple]:
        """Rows of a block of marks; a mark with one context that occurs often needs no array."""
        open_ = [row for mark in block for row in mark if len(mark) > 1 or row[3] == 1]
        found = {}
        for kind, compare, size in (0, repeated_starts, length), (1, repeated_passages, words):
            rows = [row for row in open_ if row[0] & 1 == kind]
            if rows:
                found.update(zip(
                    [row[:2] for row in rows], compare([row[2] for row in rows], size)))
        for mark in block:
            for number, key, context, n in mark:
                first, last = windows(context, number, length, words)
                starts, ends = runs_of(
                    np.ones(len(first), bool) if n > 1 else found[(number, key)])
                if starts:
                    yield number, key, first[starts].tolist(), last[np.array(ends) - 1].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[list[tuple]] = []
        size = 0

        def done() -> pa.RecordBatch:
            rows = list(zip(*flag(block))) or [[]] * 4
            ints = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.binary(), ints, ints))],
                ["mark", "context_key", "starts", "ends"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist()
                             for c in ("mark", "context_key", "context", "n"))):
                if not block or block[-1][0][0] != row[0]:
                    if size >= BLOCK_BYTES:
                        yield done()
                        block, size = [], 0
                    block.append([])
                block[-1].append(row)
                size += len(row[2])
        if block:
            yield done()

    spread = contexts.repartition("mark").sortWithinPartitions("mark", "context_key")
    return spread.select("mark", "context_key", "context", "n").mapInArrow(run, FLAGGED)


def compare_strings(contexts: DataFrame, length: int, words: int) -> DataFrame:
    """The same for marks with very many contexts: every string is counted by its digest."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for mark, key, context, n in zip(*(
                    batch.column(c).to_pylist() for c in ("mark", "context_key", "context", "n"))):
                for i, j in zip(*(x.tolist() for x in windows(context, mark, length, words))):
                    string = b" ".join(context[i:j].split()) if mark & 1 else context[i:j]
                    rows.append((mark, key, i, j, hashlib.md5(string).digest(), n))
            types = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)), types)],
                ["mark", "context_key", "start", "end", "string", "n"])

        return step

    strings = map_batches(
        contexts.select("mark", "context_key", "context", "n"), make,
        "mark long, context_key binary, start int, end int, string binary, n long")
    often = strings.groupBy("mark", "string").agg(F.sum("n").alias("n")).filter("n > 1")
    hits = strings.drop("n").join(often.drop("n"), ["mark", "string"])
    spans = hits.groupBy("mark", "context_key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    return spans.select(
        "mark", "context_key", F.col("spans.start").alias("starts"),
        F.col("spans.end").alias("ends"))


def removals(docs: DataFrame, length: int = LENGTH, words: int = 0) -> tuple[DataFrame, DataFrame]:
    """What to remove: one row per row of ``docs``, and one per different text.

    First: the columns of ``docs`` but ``text``, then (text_key, n_bytes, sha256). Second:
    (text_key, text, spans, twice) of the texts in which something is repeated; spans are
    (begin, end, passage) in bytes, ``twice`` says that the whole text is. With ``words``,
    passages of so many equal words, whatever stands between them, are found as well.
    """
    keyed = docs.withColumn("text_key", text_key())
    marked = stored(text_marks(keyed, length, words), "marks")
    texts = stored(
        marked.groupBy("text_key").agg(
            F.count("*").alias("copies"), F.first("runs").alias("runs")).filter("size(runs) > 0"),
        "texts")
    rows = stored(marked.drop("runs"), "marks")
    remove_stored(marked)
    runs = texts.select("text_key", F.explode("runs").alias("run")).select("text_key", "run.*")
    often = runs.groupBy("mark").agg(F.count("*").alias("n"), F.max("several").alias("several"))
    often = often.filter("n > 1 or several").select("mark")
    candidates = (
        runs.drop("several").join(often, "mark").groupBy("text_key")
        .agg(F.collect_list(F.struct("mark", "begin", "end")).alias("runs")))
    # texts that occur more than once are compared too: parts of them may stand elsewhere
    twice = texts.filter("copies > 1").select("text_key")
    needed = candidates.join(twice.withColumn("twice", F.lit(True)), "text_key", "full")
    one = (
        docs.select(text_key(), "text")
        .groupBy("text_key").agg(F.first("text").alias("text")))
    chosen = stored(one.join(needed, "text_key"), "texts")
    remove_stored(texts)
    contexts = stored(cut_contexts(
        chosen.filter("runs is not null").select("text_key", "text", "runs")), "contexts")
    different = stored(
        contexts.groupBy("mark", "context_key").agg(
            F.first("context").alias("context"), F.count("*").alias("n")), "different")
    member = stored(contexts.drop("context"), "contexts")
    remove_stored(contexts)
    hot = different.groupBy("mark").agg(F.sum(F.octet_length("context")).alias("m")).filter(
        F.col("m") > HOT_BYTES).select("mark")
    flagged = stored(
        compare_contexts(different.join(hot, "mark", "left_anti"), length, words).unionByName(
            compare_strings(different.join(hot, "mark"), length, words)),
        "flagged")
    remove_stored(different)
    passage = F.col("mark").bitwiseAND(F.lit(1)) == 1
    spans = (
        flagged.join(member, ["mark", "context_key"]).groupBy("text_key")
        .agg(F.collect_list(F.struct(
            "begin", "starts", "ends", passage.alias("passage"))).alias("runs")))
    spans = spans.select("text_key", F.flatten(F.transform("runs", lambda r: F.zip_with(
        r["starts"], r["ends"], lambda x, y: F.struct(
            (r["begin"] + x).alias("begin"), (r["begin"] + y).alias("end"),
            r["passage"].alias("passage"))))).alias("spans"))
    removed = (
        chosen.select("text_key", "text", "twice").join(spans, "text_key", "left")
        .filter("spans is not null or twice")
        .select("text_key", "text", "spans", F.coalesce("twice", F.lit(False)).alias("twice")))
    return rows, removed


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal removed runs."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for begin, end in spans:
        parts.append(raw[at:begin])
        at = end
    return b"".join(parts) + raw[at:]


def repeated_spans(
    raw: bytes, spans: list[dict] | None, twice: bool, length: int, words: int,
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Maximal runs of repeated strings of ``length`` bytes, and of passages."""
    found: tuple[list, list] = ([], [])
    for s in spans or []:
        found[s["passage"]].append((s["begin"], s["end"]))
    if twice:
        if len(raw) >= length:
            found[0].append((0, len(raw)))
        first, last = word_edges(np.frombuffer(raw, np.uint8))
        if words and len(first) >= words:
            found[1].append((int(first[0]), int(last[-1])))
    return merged_spans(found[0]), merged_spans(found[1])


KEPT = "text_key binary, n_removed long, n_spans long, n_passages long, n_passage_words long, kept "


def kept_texts(
    removed: DataFrame, length: int = LENGTH, words: int = 0, as_text: bool = False,
) -> DataFrame:
    """Texts with repeated strings: (text_key, n_removed, n_spans, n_passages, n_passage_words,
    kept).

    ``kept`` are the bytes without repeated strings of ``length`` bytes; with ``as_text`` it is
    a text without passages either, and without characters of which only a part stays.
    Passages are maximal runs of repeated words.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for key, text, spans, twice in zip(*(
                    batch.column(c).to_pylist() for c in ("text_key", "text", "spans", "twice"))):
                raw = text.encode()
                runs, passages = repeated_spans(raw, spans, twice, length, words)
                n_words = sum(len(raw[a:b].split()) for a, b in passages)
                if as_text:
                    runs = merged_spans(runs + passages)
                left = without(raw, runs)
                rows.append((
                    key, sum(b - a for a, b in runs), len(runs), len(passages), n_words,
                    left.decode(errors="ignore") if as_text else left))
            kinds = [pa.binary(), *[pa.int64()] * 4, pa.string() if as_text else pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                ["text_key", "n_removed", "n_spans", "n_passages", "n_passage_words", "kept"])

        return step

    return map_batches(removed, make, KEPT + ("string" if as_text else "binary"))


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document without its repeated strings of ``LENGTH`` bytes. A null
    text is empty.

    Passages of ``PASSAGE_WORDS`` or more words that stand in several places are counted beside
    it (n_passages, n_passage_words), since they may have fewer bytes.
    """
    docs = table(spark, folder, "documents").select("doc_id", text_or_empty())
    rows, removed = removals(docs, words=PASSAGE_WORDS)
    counts = ["n_removed", "n_spans", "n_passages", "n_passage_words"]
    kept = kept_texts(removed, words=PASSAGE_WORDS).select(
        "text_key", *counts, F.sha2("kept", 256).alias("kept_sha256"))
    whole = rows.join(kept, "text_key", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in counts})
    return whole.select(
        "doc_id", "n_bytes", "n_removed", "n_spans",
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), "n_passages", "n_passage_words")


def cut_repeats(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """All rows and columns of ``docs``; repeated strings are cut from ``text``. Characters
    of which only a part was repeated go with it. A null text stays null. With ``words``,
    passages of so many words that stand in several places are cut as well."""
    _, removed = removals(docs.select(text_or_empty()), length, words)
    clean = kept_texts(removed, length, words, as_text=True).select("text_key", "kept")
    whole = docs.select(F.struct(*docs.columns).alias("row"), text_or_empty()).select(
        "row", text_key())
    return whole.join(clean, "text_key", "left").select(*[
        F.coalesce("kept", "row.text").alias("text") if c == "text"
        else F.col(f"row.`{c}`").alias(c) for c in docs.columns
    ])
