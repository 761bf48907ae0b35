"""Every corpus query on awkward, empty and given tables, against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict
from math import log10
from zlib import crc32

import pytest

import fixtures
from tallywatch.llm.queries import QUERIES

TEXTS = fixtures.texts()
ROWS = {
    name: ["page_id"] if name == "op6_html" else ["bin_id"] if name == "op7_packing"
    else ["query_id"] if name == "op10_topk" else ["doc_id"] for name in QUERIES
}


def collected(spark, name, folder):
    return [r.asDict(recursive=True) for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, empty, name):
    result = QUERIES[name](spark, empty)
    assert result.collect() == []
    assert set(ROWS[name]) <= set(result.columns)


@pytest.mark.parametrize(
    "name", sorted(set(QUERIES) - {"op6_html", "op7_packing", "op10_topk"}))
def test_one_row_per_document_whatever_its_text(spark, odd, name):
    found = Counter(r["doc_id"] for r in collected(spark, name, odd))
    assert found == Counter(i for i, _ in TEXTS)


def by_id(rows):
    return {r["doc_id"]: r for r in rows if r["doc_id"] is not None}


def test_base_spans_of_secrets(spark, odd):
    patterns = [
        ("assign", r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
         r"""([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    found = by_id(collected(spark, "op2_secrets", odd))
    for doc, text in TEXTS:
        if doc is None:
            continue
        spans = sorted(
            (m.start(), k, f"{kind}:{m.start()}:{m.end()}")
            for k, (kind, pattern, good) in enumerate(patterns)
            for m in re.finditer(pattern, text or "") if good(m))
        digest = hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        assert found[doc]["base_sha256"] == digest
        counts = Counter(s[1] for s in spans)
        assert [found[doc][c] for c in ("n_assign", "n_access", "n_hex")] == [
            counts[0], counts[1], counts[2]]
        assert set(s[2] for s in spans) <= set(found[doc]["spans"].split(","))


def test_tokens_equal_the_library(spark, odd):
    import base64

    import public_tokenizers as public
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(
        bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(collected(spark, "op3_bpe", odd))
    for doc, text in TEXTS:
        if doc is not None:
            ids = library.encode_ordinary(text or "")
            assert found[doc]["n_tokens"] == len(ids)
            assert found[doc]["ids_sha256"] == hashlib.sha256(
                ",".join(map(str, ids)).encode()).hexdigest()
            assert found[doc]["decoded_sha256"] == hashlib.sha256(
                (text or "").encode()).hexdigest()


def test_language_model_counts_and_base_scores(spark, odd):
    def tokens(text):
        return (text or "").encode().lower().split() + [b"\n"]

    counts = Counter()
    for doc, text in TEXTS:
        if crc32(str("" if doc is None else doc).encode()) % 7 != 2:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    found = by_id(collected(spark, "op4_lm", odd))
    for doc, text in TEXTS:
        if doc is None:
            continue
        row, own = found[doc], tokens(text)
        assert row["held_out"] == (crc32(str(doc).encode()) % 7 == 2)
        assert (row["n_tokens"], row["train_tokens"]) == (len(own), n)
        assert row["n_known"] == sum(counts[w] > 0 for w in own)
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] < 0


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))}


def test_components_equal_brute_force(spark, odd):
    sets = [shingles(t) for _, t in TEXTS]
    root = list(range(len(TEXTS)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc, _) in enumerate(TEXTS):
        members[find(i)].append(doc)
    expected = Counter()
    for i, (doc, text) in enumerate(TEXTS):
        named = [d for d in members[find(i)] if d is not None]
        least = min(named) if named and sets[i] else doc
        expected[(doc, len(sets[i]), least, doc == least)] += 1
    rows = collected(spark, "op5_neardup", odd)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                   for r in rows) == expected


def test_quality_base_counts(spark, odd):
    found = by_id(collected(spark, "op8_quality", odd))
    for doc, text in TEXTS:
        if doc is None:
            continue
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        places = defaultdict(list)
        for i in range(len(words) - 7):
            places[tuple(words[i:i + 8])].append(i)
        inside = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
        row = found[doc]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(inside)
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])
    assert not any(found[i]["kept"] for i in (400, 401, 500, 501, 502))
    assert sum(found[i]["kept"] for i in range(60)) >= 57


def removed_bytes(texts, length):
    """Plain version: every string of every text in one dictionary."""
    raws = [(t or "").encode() for t in texts]
    places = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if places[raw[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append(gone)
    return raws, out


def test_repeats_equal_brute_force(spark, odd):
    texts = [(d, t) for d, t in TEXTS]
    raws, gone = removed_bytes([t for _, t in texts], 400)
    expected = Counter()
    for (doc, _), raw, mask in zip(texts, raws, gone):
        kept = bytes(b for b, g in zip(raw, mask) if not g)
        spans = sum(g and not (i and mask[i - 1]) for i, g in enumerate(mask))
        expected[(doc, len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest())] += 1
    rows = collected(spark, "op9_repeats", odd)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                   for r in rows) == expected


def test_packing_holds_every_token_once(spark, odd):
    bins = collected(spark, "op7_packing", odd)
    pieces = Counter()
    for row in bins:
        assert row["capacity"] in (512, 1024, 2048, 4096)
        assert row["n_tokens"] == sum(p["length"] for p in row["pieces"]) <= row["capacity"]
        assert row["capacity"] == 512 or row["n_tokens"] > row["capacity"] // 2
        for p in row["pieces"]:
            pieces[(p["doc_id"], p["start"], p["length"])] += 1
    expected = Counter()
    for doc, text in TEXTS:
        n = len((text or "").encode().split()) + 1
        for start in range(0, n, 4096):
            expected[(doc, start, min(4096, n - start))] += 1
    assert pieces == expected


def test_toxicity_is_learned_from_the_training_fold_only(spark, tmp_path):
    import random

    draw = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        lines = [fixtures.sentence(draw, 8) for _ in range(8)]
        if toxic:
            at = draw.randrange(8)
            lines[at] = lines[at].replace(" ", f" {draw.choice(['vilea', 'vileo', 'scumm'])} ", 1)
        docs.append((i, "\n".join(lines), "en", "s", 1, "", "", "", "", "", ""))
        # labels of the held-out fold are wrong on purpose
        held_out = crc32(str(i).encode()) % 5 == 0
        labels.append((i, 1, int(toxic != held_out), "t"))
    folder = fixtures.folder(spark, tmp_path / "toxic", docs, labels)
    found = by_id(collected(spark, "op1_toxicity", folder))
    for i in range(900):
        assert found[i]["held_out"] == (crc32(str(i).encode()) % 5 == 0)
        assert 0 <= found[i]["score"] <= 1
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.5)
    right = sum(found[i]["predicted"] == int(i % 3 == 0) for i in range(900))
    assert right >= 880


def test_language_model_beats_the_counts_on_held_out_text(spark, data):
    rows = [r for r in collected(spark, "op4_lm", data) if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_toxicity_on_held_out_documents(spark, data):
    scored = QUERIES["op1_toxicity"](spark, data).filter("held_out")
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


def test_topk_equals_sql(spark, data):
    import duckdb

    from tallywatch.llm.queries import ORACLES

    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data}/documents.parquet')")
    expected = connection.execute(ORACLES["op10_topk"]).fetchall()
    rows = QUERIES["op10_topk"](spark, data).collect()
    assert sorted(map(tuple, rows)) == sorted(expected)


def test_topk_of_awkward_rows(spark, odd):
    rows = collected(spark, "op10_topk", odd)
    asked = {d for d, t in TEXTS if d is not None and d % 20 == 0}
    assert {r["query_id"] for r in rows} <= asked
    ranks = defaultdict(list)
    for r in rows:
        ranks[r["query_id"]].append((r["rank"], -r["score"], r["doc_id"]))
    for found in ranks.values():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1)) and len(found) <= 10
        assert [f[1] for f in found] == sorted(f[1] for f in found)
