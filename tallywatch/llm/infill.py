"""Fill-in-the-middle forms of documents, on a piece table.

A document is a list of descriptors, each naming a stretch of one of two buffers that never
change: the text itself and the sentinels. Cutting splits the descriptor that holds the place,
arranging puts the parts in another order with sentinels between them, and the inverse
arrangement drops the sentinels and restores the order. No text is built to do so; digests
read the buffers stretch by stretch, and only a caller that wants the text joins them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.common import map_batches, other_columns, replace_columns, table, text_or_empty

SENTINELS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
SEED = 7
"""Goes into the hash that decides cuts and forms."""
RATE, SPM_RATE = 100, 50
"""Percent of the documents that are transformed, and of these in suffix-first order."""
STREAM = 1 << 20
"""Characters that a digest reads at a time."""

ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
"""Order of the parts in each form."""
TEXT, MARKS = 0, 1
"""The two buffers."""


class Piece(NamedTuple):
    """A stretch of a buffer, by characters."""

    buffer: int
    begin: int
    end: int


@dataclass(frozen=True)
class PieceTable:
    """Immutable buffers and the descriptors that make up the document."""

    buffers: tuple[str, str]
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: str) -> PieceTable:
        return cls((text, "".join(SENTINELS.values())), (Piece(TEXT, 0, len(text)),))

    def cut(self, places: Iterable[int]) -> PieceTable:
        """Split the descriptors that hold the places, counted in characters of the document.
        A place at the edge of a descriptor, or given twice, leaves an empty descriptor, so
        that n places make n more descriptors."""
        pieces = list(self.pieces)
        for place in sorted(places, reverse=True):
            begin = 0
            for n, piece in enumerate(pieces):
                size = piece.end - piece.begin
                if place <= begin + size:
                    at = piece.begin + place - begin
                    pieces[n:n + 1] = [piece._replace(end=at), piece._replace(begin=at)]
                    break
                begin += size
        return PieceTable(self.buffers, tuple(pieces))

    def arrange(self, form: str) -> PieceTable:
        """The three parts (prefix, middle, suffix) in the order of the form, each behind its
        sentinel."""
        parts = dict(zip(("prefix", "middle", "suffix"), self.pieces, strict=True))
        marks = mark_pieces()
        return PieceTable(
            self.buffers,
            tuple(p for name in ORDERS[form] for p in (marks[name], parts[name])))

    def restore(self, form: str) -> PieceTable:
        """The inverse of ``arrange``: sentinels go, the parts stand in their old order."""
        parts = dict(zip(ORDERS[form], (p for p in self.pieces if p.buffer == TEXT), strict=True))
        return PieceTable(
            self.buffers, tuple(parts[name] for name in ("prefix", "middle", "suffix")))

    def stream(self) -> Iterator[bytes]:
        """UTF-8 of the document, descriptor by descriptor, at most STREAM characters a time."""
        for buffer, begin, end in self.pieces:
            source = self.buffers[buffer]
            for at in range(begin, end, STREAM):
                yield source[at:min(at + STREAM, end)].encode()

    def digest(self) -> str:
        found = hashlib.sha256()
        for part in self.stream():
            found.update(part)
        return found.hexdigest()

    def text(self) -> str:
        return "".join(self.buffers[b][begin:end] for b, begin, end in self.pieces)


def mark_pieces() -> dict[str, Piece]:
    """Where each sentinel stands in its buffer."""
    out, at = {}, 0
    for name, mark in SENTINELS.items():
        out[name] = Piece(MARKS, at, at + len(mark))
        at += len(mark)
    return out


def unit_ends(text: str) -> list[int]:
    """Where the lines of a text end, each with its line feed."""
    ends = list(accumulate(len(line) + 1 for line in text.split("\n")))
    # what follows the last line feed has none of its own, and is no line if empty
    return ends[:-1] if text.endswith("\n") or not text else [*ends[:-1], len(text)]


def draw(key: str, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that depend on the key alone."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def form_of(text: str, numbers: tuple[int, int, int, int], rate: int, spm_rate: int) -> str:
    """plain, psm or spm. A text that holds a sentinel could not be restored and stays plain."""
    if not text or any(mark in text for mark in SENTINELS.values()) or numbers[2] % 100 >= rate:
        return "plain"
    return "spm" if numbers[3] % 100 < spm_rate else "psm"


@dataclass(frozen=True)
class Infilled:
    """A transformed document; ``cuts`` are characters, none for a plain one."""

    n_units: int
    form: str
    cuts: tuple[int, int] | None
    table: PieceTable


def infill(text: str, key: str, seed: int = SEED, rate: int = RATE,
           spm_rate: int = SPM_RATE) -> Infilled:
    """Cut a text between lines at two drawn places, and arrange the parts by the drawn form."""
    ends = unit_ends(text)
    numbers = draw(key, seed)
    form = form_of(text, numbers, rate, spm_rate)
    plain = PieceTable.of(text)
    if form == "plain":
        return Infilled(len(ends), form, None, plain)
    borders = [0, *ends]
    first, second = sorted(h % len(borders) for h in numbers[:2])
    cuts = borders[first], borders[second]
    return Infilled(len(ends), form, cuts, plain.cut(cuts).arrange(form))


def table_of_output(text: str, form: str) -> PieceTable:
    """The piece table of an output, from its text and form alone: the sentinels, of which no
    transformed document holds any, show where its parts begin."""
    if form == "plain":
        return PieceTable.of(text)
    marks = mark_pieces()
    begins = [text.index(SENTINELS[name]) for name in ORDERS[form]]
    ends = [*begins[1:], len(text)]
    return PieceTable((text, "".join(SENTINELS.values())), tuple(
        piece for name, begin, end in zip(ORDERS[form], begins, ends)
        for piece in (marks[name], Piece(TEXT, begin + len(SENTINELS[name]), end))))


def restored(text: str, form: str) -> PieceTable:
    """The document that an output was made from."""
    found = table_of_output(text, form)
    return found if form == "plain" else found.restore(form)


# --- Spark ----------------------------------------------------------------------------


def _each_text(docs: DataFrame, added: str, finish: Callable[[str, str], tuple]) -> DataFrame:
    """Columns of ``docs`` but ``text``, then what ``finish`` makes of a text and its id. Columns
    with the name of an added one are replaced. A null text is empty, a null id the empty key."""
    extra = StructType.fromDDL(added)
    others = other_columns(docs, extra.names)
    schema = StructType([docs.schema[c] for c in others] + extra.fields)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key")
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string()}

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [finish(*row) for row in zip(
                batch.column("text").to_pylist(), batch.column("_key").to_pylist())]
            return replace_columns(batch, ["text", "_key"], **{
                f.name: pa.array(c, kinds[f.dataType.simpleString()])
                for f, c in zip(extra.fields, zip(*rows))})

        return step

    return map_batches(docs.select(*others, text_or_empty(), key), make, schema)


def infill_documents(docs: DataFrame, seed: int = SEED, rate: int = RATE,
                     spm_rate: int = SPM_RATE) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``n`` (lines), ``form``, ``cut_1`` and ``cut_2`` (in
    characters, null if plain) and ``output``, the transformed text.

    A null text is empty and stays plain; equal rows are treated alike, as are rows without id.
    """

    def finish(text: str, key: str) -> tuple:
        found = infill(text, key, seed, rate, spm_rate)
        return found.n_units, found.form, *(found.cuts or (None, None)), found.table.text()

    return _each_text(
        docs, "n long, form string, cut_1 long, cut_2 long, output string", finish)


def restore_documents(infilled: DataFrame) -> DataFrame:
    """All columns, and ``text`` as it was before ``infill_documents``."""
    rows = infilled.withColumn("text", F.col("output"))
    extra = StructType.fromDDL("text string")
    others = [c for c in infilled.columns if c != "text"]
    schema = StructType([infilled.schema[c] for c in others] + extra.fields)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if t is None else restored(t, f).text() for t, f in zip(
                batch.column("output").to_pylist(), batch.column("form").to_pylist())]
            return replace_columns(batch, ["text"], text=pa.array(texts, pa.string()))

        return step

    return map_batches(rows.select(*others, "text"), make, schema)


def digest_infills(docs: DataFrame, seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``n``, ``form``, the characters of prefix and
    middle, and digests of the output and of the text that output and form give back, both
    streamed from the buffers."""

    def finish(text: str, key: str) -> tuple:
        found = infill(text, key, seed, rate, spm_rate)
        first, second = found.cuts or (None, None)
        return (found.n_units, found.form, first,
                None if found.cuts is None else second - first,
                found.table.digest(), restored(found.table.text(), found.form).digest())

    return _each_text(
        docs, "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
        "restored_sha256 string", finish)


def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    """Form, cuts and digests of every document's fill-in-the-middle form."""
    return digest_infills(table(spark, folder, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM base),
placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:c1], '') AS prefix,
         array_to_string(units[c1 + 1:c2], '') AS middle,
         array_to_string(units[c2 + 1:], '') AS suffix
  FROM placed)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
         AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
