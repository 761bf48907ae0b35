"""Secret scan: three fixed patterns and a linear-chain conditional random field.

The field tags every token as the begin of a secret, inside one, or outside. Its features
are the shapes of the token and its neighbours, the neighbouring words, and properties of
the whole text. It is trained on windows around the patterns' own matches and around other
tokens with digits, so that it finds secrets in contexts that the patterns miss.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.common import KNOWN_WORDS, map_batches, replace_columns, table, text_or_empty

# The base patterns, their least lengths, and their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGNED, LEAST_HEX = 6, 24
KINDS = ("assign", "access", "hex")
FIELD = "field"
"""Kind of a span that only the random field found."""

SAMPLE_HITS, SAMPLE_OTHERS = 1_200, 400
"""Training documents with and without a match, at most."""
WINDOWS_PER_TEXT = 2
WIDTH = 17
"""Tokens of a training window."""
REACH = 2
"""Neighbours on either side that a token's features see."""
EPOCHS, RATE, SHRINK = 60, 0.1, 1e-4
BUCKETS = 1 << 14
FREQUENT = 5
"""Times a word must occur in the training windows to be a feature by itself."""
TOKEN = re.compile(r"\w+|[^\w\s]")
OUT, BEGIN, INSIDE = 0, 1, 2
FORBIDDEN = -1e4
"""Score of a step from outside to inside."""

Span = tuple[int, int, str]


def hex_run(raw: bytes) -> bool:
    """Whether some run of hex digits is long enough for a match."""
    codes = np.frombuffer(raw, np.uint8)
    other = ~(((codes >= 48) & (codes <= 57)) | ((codes >= 97) & (codes <= 102)))
    ends = np.concatenate([[-1], np.flatnonzero(other), [len(codes)]])
    return bool((np.diff(ends) > LEAST_HEX).any())


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the patterns' matches, by start, then kind as listed.

    ``AKIA`` runs and hex runs are maximal, so asking for the least length in the pattern
    drops the same matches as checking it afterwards. Assignments are checked afterwards.
    """
    spans = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    if hex_run(text.encode()):
        spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


SIZES = [int(np.searchsorted((2, 3, 6, 10, 16, 20, 24, 32, 40), n, side="right"))
         for n in range(41)]
"""Coarse length by length."""


def shape(token: str) -> str:
    """Kinds of characters, coarse length, and how often letters and digits alternate."""
    turns = 0
    if not token.isascii():
        kind = "other"
    elif token.isalpha():
        kind = ("lower" if token.islower() else "upper" if token.isupper()
                else "title" if token.istitle() else "mixed")
    elif token.isdigit():
        kind = "digits"
    elif token.isalnum():
        letters = re.sub(r"\d", "", token)
        kind = ("hex" if set(letters) <= set("abcdef") else "lower1" if letters.islower()
                else "upper1" if letters.isupper() else "mixed1")
        turns = min(sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:])), 12) // 3
    else:
        kind = "joined" if len(token) > 1 else "mark"
    return f"{kind}/{SIZES[min(len(token), 40)]}/{turns}"


def buckets(token: str, words: frozenset[str]) -> tuple[int, ...]:
    """Feature buckets of one token, the same for every distance to it. Only words that are
    frequent in the training windows have a bucket of their own."""
    low = token.lower()
    return form_buckets(shape(token), low if low in words else "")


@lru_cache(maxsize=100_000)
def form_buckets(form: str, word: str) -> tuple[int, ...]:
    parts = (f"w{word}", f"s{form}", f"k{form.split('/')[0]}")
    return tuple(xxhash.xxh64_intdigest(p) % BUCKETS for p in parts)


def file_buckets(text: str, n_tokens: int) -> tuple[int, int]:
    """Shares of digits and of assignment marks in the text, coarsely, as buckets."""
    raw = text.encode()
    digits = (len(raw) - len(raw.translate(None, b"0123456789"))) / max(len(raw), 1)
    marks = (raw.count(b"=") + raw.count(b":")) / max(n_tokens, 1)
    return (int(np.searchsorted((0.001, 0.01, 0.05), digits)),
            4 + int(np.searchsorted((0.001, 0.01, 0.05), marks)))


@dataclass
class SecretModel:
    """``weights[distance, bucket, tag]``, ``file[bucket, tag]`` and ``steps[from, to]``."""

    weights: np.ndarray
    file: np.ndarray
    steps: np.ndarray
    words: frozenset[str]


class FormIds(dict):
    """Number of each token's feature set, and the score rows of all feature sets."""

    def __init__(self, model: SecretModel):
        super().__init__()
        self.model = model
        self.numbers: dict[tuple[int, ...], int] = {}
        self.rows = np.zeros((2 * REACH + 1, 1024, 3))

    def __missing__(self, token: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        key = buckets(token, self.model.words)
        if key not in self.numbers:
            at = self.numbers[key] = len(self.numbers)
            if at >= self.rows.shape[1]:
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)], axis=1)
            self.rows[:, at] = self.model.weights[:, list(key)].sum(axis=1)
        self[token] = self.numbers[key]
        return self[token]


class Tagger:
    """Viterbi decoding with a memory of token features."""

    def __init__(self, model: SecretModel):
        self.model = model
        self.forms = FormIds(model)
        steps = model.steps - model.steps[OUT, OUT]
        #: most that one step can add to a path beside the outside-only path
        self.slack = float(max(0.0, steps[steps > FORBIDDEN / 2].max()))

    def emissions(self, tokens: list[str], text: str) -> np.ndarray:
        ids = np.fromiter(map(self.forms.__getitem__, tokens), np.int64, len(tokens))
        rows = self.forms.rows
        out = rows[REACH].take(ids, axis=0)
        out += self.model.file[list(file_buckets(text, len(tokens)))].sum(axis=0)
        for d in range(1, REACH + 1):
            out[d:] += rows[REACH - d].take(ids[:-d], axis=0)
            out[:-d] += rows[REACH + d].take(ids[d:], axis=0)
        return out

    def tags(self, tokens: list[str], text: str) -> np.ndarray:
        """Best tag sequence of the whole text.

        Beside the outside-only path, a stretch of tagged tokens gains at most the sum of
        its tokens' best gains plus the slack of its steps. Only tokens inside some stretch
        for which that is positive can be tagged, so only those runs are decoded.
        """
        found = np.zeros(len(tokens), np.int64)
        if not tokens:
            return found
        scores = self.emissions(tokens, text)
        gain = np.maximum(scores[:, 1], scores[:, 2]) - scores[:, 0] + self.slack
        if not (gain + self.slack > 0).any():
            return found
        total = np.concatenate([[0.0], np.cumsum(gain)])
        left = total[1:] - np.minimum.accumulate(total[:-1])
        right = np.maximum.accumulate(total[::-1])[::-1][1:] - total[:-1]
        live = left + right - gain + self.slack > -1e-6
        edges = np.flatnonzero(np.diff(np.concatenate([[0], live.astype(np.int8), [0]])))
        for begin, end in zip(edges[::2], edges[1::2]):
            found[begin:end] = viterbi(
                scores[begin:end], self.model.steps, begin > 0, end < len(tokens))
        return found

    def spans(self, text: str) -> list[Span]:
        """Runs tagged begin, inside, ... as (start, end, kind), in code points."""
        tokens = TOKEN.findall(text)
        tags = self.tags(tokens, text)
        if not tags.any():
            return []
        places = [m.span() for m in TOKEN.finditer(text)]
        out: list[Span] = []
        for at in np.flatnonzero(tags):
            if tags[at] == BEGIN or not out:
                out.append((*places[at], FIELD))
            else:
                out[-1] = (out[-1][0], places[at][1], FIELD)
        return out


def viterbi(scores: np.ndarray, steps: np.ndarray, before: bool, after: bool) -> np.ndarray:
    """Best path through one run; ``before`` and ``after``: an outside token stands there."""
    n = len(scores)
    back = np.zeros((n, 3), np.int64)
    best = scores[0] + (steps[OUT] if before else np.array([0.0, 0.0, FORBIDDEN]))
    for t in range(1, n):
        ways = best[:, None] + steps
        back[t] = ways.argmax(axis=0)
        best = ways.max(axis=0) + scores[t]
    path = [int((best + (steps[:, OUT] if after else 0.0)).argmax())]
    for t in range(n - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return np.array(path[::-1])


def all_spans(text: str, tagger: Tagger) -> list[Span]:
    """The base spans, and those of the field that do not lie within them."""
    base = base_spans(text)
    starts = [s[0] for s in base]
    reach = np.maximum.accumulate([s[1] for s in base]) if base else np.empty(0)
    extra = []
    for span in tagger.spans(text):
        covered = span[0]
        while covered < span[1]:
            at = int(np.searchsorted(starts, covered, "right"))
            if at == 0 or reach[at - 1] <= covered:
                extra.append(span)
                break
            covered = reach[at - 1]
    order = (*KINDS, FIELD)
    return sorted(base + extra, key=lambda s: (s[0], order.index(s[2])))


# --- training -------------------------------------------------------------------------


def secret_value(text: str, span: Span) -> tuple[int, int]:
    """The part of a match that is the secret itself."""
    if span[2] != "assign":
        return span[:2]
    found = ASSIGN.match(text, span[0])
    return found.span(2) if found else span[:2]


def silver_tags(text: str, places: list[tuple[int, int]]) -> np.ndarray:
    tags = np.zeros(len(places), np.int64)
    begins = np.array([p[0] for p in places])
    for span in base_spans(text):
        start, end = secret_value(text, span)
        inside = np.flatnonzero((begins >= start) & (begins < end))
        if len(inside):
            tags[inside] = INSIDE
            tags[inside[0]] = BEGIN
    return tags


def training_windows(text: str) -> list[tuple[list[str], list[int], tuple[int, int]]]:
    """Up to WINDOWS_PER_TEXT windows around matches, as many around other tokens with
    digits, and as many at places spread over the text."""
    places = [m.span() for m in TOKEN.finditer(text)]
    if not places:
        return []
    tokens = [text[a:b] for a, b in places]
    tags = silver_tags(text, places)
    file = file_buckets(text, len(tokens))
    digits = [i for i, t in enumerate(tokens) if not tags[i] and any(c.isdigit() for c in t)]
    spread = range(0, len(tokens), max(1, len(tokens) // WINDOWS_PER_TEXT))
    centres = [list(np.flatnonzero(tags == BEGIN)), digits, list(spread)]
    out = []
    for places_ in centres:
        for centre in places_[:: max(1, len(places_) // WINDOWS_PER_TEXT)][:WINDOWS_PER_TEXT]:
            begin = max(0, int(centre) - WIDTH // 2)
            out.append((tokens[begin:begin + WIDTH], tags[begin:begin + WIDTH].tolist(), file))
    return out


def sample_windows(docs: DataFrame, hits: int, others: int) -> DataFrame:
    """Training windows of at most ``hits`` texts with a match and ``others`` without.

    Texts are chosen by the hash of their content, so copies of one text count once.
    """
    likely = (
        F.col("text").rlike(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}")
        | F.col("text").rlike(f"(?i)(?:{'|'.join(ASSIGN_WORDS)})[\"']? *[:=]")
    )
    texts = docs.select(F.xxhash64("text").alias("key"), likely.alias("hit"), text_or_empty())
    chosen = [
        texts.filter(flag).select("key").distinct().orderBy("key").limit(n)
        for flag, n in ((F.col("hit"), hits), (~F.col("hit"), others))
    ]
    keys = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most hits + others keys
    rows = texts.join(keys, "key").groupBy("key").agg(F.min("text").alias("text"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [training_windows(t) for t in batch.column("text").to_pylist()]
            flat = [w for windows in found for w in windows]
            return pa.RecordBatch.from_arrays([
                pa.array([w[0] for w in flat], pa.list_(pa.string())),
                pa.array([w[1] for w in flat], pa.list_(pa.int32())),
                pa.array([list(w[2]) for w in flat], pa.list_(pa.int32())),
            ], ["tokens", "tags", "file"])

        return step

    return map_batches(
        rows.select("text"), make, "tokens array<string>, tags array<int>, file array<int>")


def log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def expected(scores: np.ndarray, steps: np.ndarray, real: np.ndarray):
    """Forward-backward over padded windows: tag probabilities and step counts."""
    n, width, _ = scores.shape
    start = np.array([0.0, 0.0, FORBIDDEN])
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0] + start
    for t in range(1, width):
        moved = log_sum(forward[:, t - 1][:, :, None] + steps, 1) + scores[:, t]
        forward[:, t] = np.where(real[:, t, None], moved, forward[:, t - 1])
    for t in range(width - 2, -1, -1):
        moved = log_sum(steps + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(real[:, t + 1, None], moved, backward[:, t + 1])
    norm = log_sum(forward[:, -1], 1)
    tags = np.exp(forward + backward - norm[:, None, None]) * real[:, :, None]
    pair = np.zeros((3, 3))
    for t in range(1, width):
        joint = (forward[:, t - 1][:, :, None] + steps
                 + (scores[:, t] + backward[:, t])[:, None, :] - norm[:, None, None])
        pair += np.exp(joint[real[:, t]]).sum(axis=0)
    return tags, pair


def fit_windows(windows: list[tuple[list[str], list[int], list[int]]]) -> SecretModel:
    """Regularised maximum likelihood by Adam. Without windows nothing is ever tagged."""
    weights = np.zeros((2 * REACH + 1, BUCKETS, 3))
    steps = np.zeros((3, 3))
    steps[OUT, INSIDE] = FORBIDDEN
    if not windows:
        file = np.zeros((8, 3))
        file[:, OUT] = 1.0
        return SecretModel(weights, file, steps, frozenset())
    n = len(windows)
    real, tags = np.zeros((n, WIDTH), bool), np.zeros((n, WIDTH), np.int64)
    parts = np.zeros((n, WIDTH, 3), np.int64)
    file_of = np.array([w[2] for w in windows])
    counted = Counter(t.lower() for tokens, _, _ in windows for t in tokens)
    words = frozenset(w for w, n in counted.items() if n >= FREQUENT and not w.isdigit())
    for i, (tokens, own, _) in enumerate(windows):
        real[i, :len(tokens)], tags[i, :len(tokens)] = True, own
        for t, token in enumerate(tokens):
            parts[i, t] = buckets(token, words)
    # a window may open in the middle of a secret
    tags[:, 0] = np.where(tags[:, 0] == INSIDE, BEGIN, tags[:, 0])
    truth = np.eye(3)[tags] * real[:, :, None]
    pairs = np.zeros((3, 3))
    both = real[:, 1:]
    np.add.at(pairs, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    used, number = np.unique(parts, return_inverse=True)
    number = number.reshape(parts.shape)
    size = 2 * REACH + 1
    theta = [np.zeros((size, len(used), 3)), np.zeros((8, 3)), steps.copy()]
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in theta]

    def spans(distance: int) -> tuple[slice, slice]:
        """Tokens with a neighbour at this distance, and the neighbours."""
        if distance < 0:
            return slice(-distance, None), slice(None, distance)
        return slice(None, WIDTH - distance), slice(distance, None)

    for epoch in range(1, EPOCHS + 1):
        scores = theta[1][file_of].sum(axis=1)[:, None, :].repeat(WIDTH, axis=1)
        for d in range(-REACH, REACH + 1):
            mine, other = spans(d)
            seen = theta[0][d + REACH][number[:, other]].sum(axis=2)
            scores[:, mine] += seen * real[:, other, None]
        guess, steps_seen = expected(scores, theta[2], real)
        gap = (truth - guess) / n
        slopes = [np.zeros_like(theta[0]), np.zeros((8, 3)), (pairs - steps_seen) / n]
        for d in range(-REACH, REACH + 1):
            mine, other = spans(d)
            part = (gap[:, mine] * real[:, other, None]).reshape(-1, 3)
            for k in range(3):
                at = number[:, other, k].ravel()
                for tag in range(3):
                    slopes[0][d + REACH, :, tag] += np.bincount(at, part[:, tag], len(used))
        np.add.at(slopes[1], file_of.T, gap.sum(axis=1)[None])
        slopes[2][OUT, INSIDE] = 0.0
        for x, slope, moment in zip(theta, slopes, moments):
            slope -= SHRINK * np.where(x < FORBIDDEN / 2, 0.0, x)
            moment[0] = 0.9 * moment[0] + 0.1 * slope
            moment[1] = 0.99 * moment[1] + 0.01 * slope ** 2
            step = moment[0] / (1 - 0.9 ** epoch)
            x += RATE * step / (np.sqrt(moment[1] / (1 - 0.99 ** epoch)) + 1e-8)
    weights[:, used] = theta[0]
    return SecretModel(weights, theta[1], theta[2], words)


def fit_secrets(docs: DataFrame, hits: int = SAMPLE_HITS, others: int = SAMPLE_OTHERS):
    rows = sample_windows(docs, hits, others).collect()  # bounded by the sample
    windows = sorted((list(r.tokens), list(r.tags), list(r.file)) for r in rows)
    return fit_windows(windows)


def find_secrets(docs: DataFrame, model: SecretModel) -> DataFrame:
    """``docs`` with ``spans``: (kind, start, end) of all secrets of the whole text in code
    points, end exclusive, by start, then kind. A null or empty text has none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    kept = [c for c in docs.columns if c != "spans"]
    added = "spans array<struct<kind: string, start: int, end: int>>"
    schema = StructType([docs.schema[c] for c in kept] + StructType.fromDDL(added).fields)
    found = pa.list_(pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make():
        tagger = Tagger(shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = [
                [{"kind": k, "start": a, "end": b} for a, b, k in all_spans(t or "", tagger)]
                for t in batch.column("text").to_pylist()
            ]
            return replace_columns(batch, [], spans=pa.array(spans, found))

        return step

    return map_batches(docs.select(*kept), make, schema)


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and places of the secrets of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_secrets(docs, fit_secrets(docs)).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != FIELD)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count(FIELD).alias("n_field"),
    )


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``; every span in ``text`` is replaced by ``mask``.
    Overlapping spans become one. A null text stays null."""
    whole = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = find_secrets(whole, fit_secrets(docs))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(),
                                   batch.column("spans").to_pylist()):
                if spans:
                    parts, at = [], 0
                    for span in spans:
                        if span["start"] >= at:
                            parts += [text[at:span["start"]], mask]
                        at = max(at, span["end"])
                    text = "".join(parts) + text[at:]
                out.append(text)
            return replace_columns(batch, ["text", "spans"], masked=pa.array(out, pa.string()))

        return step

    schema = StructType([found.schema["row"]] + StructType.fromDDL("masked string").fields)
    clean = map_batches(found, make, schema)
    return clean.select(*[
        F.col("masked").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ])
