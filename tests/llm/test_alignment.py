"""Cross-tokenizer alignment against plain merging and the libraries on whole texts."""

import hashlib
from collections import Counter
from itertools import accumulate

import fixtures
import numpy as np
import pytest

from tallywatch.llm import alignment as al
from tallywatch.llm.queries import QUERIES


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers as public

    return public.path(al.FILE_A), public.path(al.FILE_B)


@pytest.fixture(scope="module")
def known(paths):
    return al.Tokenizers(open(paths[0], encoding="utf-8").read(), open(paths[1], "rb").read())


@pytest.mark.parametrize("seed", range(10))
@pytest.mark.parametrize("piece", [1, 2, 7, 128])
def test_merge_path_against_a_plain_merge(seed, piece):
    draw = np.random.default_rng(seed)
    last = int(draw.integers(1, 200))
    a, b = (np.append(np.flatnonzero(draw.random(last - 1) < share) + 1, last)
            for share in draw.random(2))
    found = al.merge_ends(a.astype(np.int64), b.astype(np.int64), piece)
    starts = [np.append(0, x[:-1]) for x in (a, b)]
    links = [(i, j) for i in range(len(a)) for j in range(len(b))
             if starts[0][i] < b[j] and starts[1][j] < a[i]]
    at = found.overlaps
    assert list(zip(found.a[at].tolist(), found.b[at].tolist())) == links
    both = sorted(set(a.tolist()) & set(b.tolist()))
    assert found.n_groups == len(both)
    assert found.group[found.from_a].tolist() == np.searchsorted(both, a).tolist()
    assert found.group[~found.from_a].tolist() == np.searchsorted(both, b).tolist()


def test_diagonals_split_the_work_evenly():
    a, b = np.arange(10, 5000, 10), np.arange(3, 5000, 3)
    cuts = np.arange(0, len(a) + len(b), 64)
    in_a = al.diagonal_cuts(a, b, cuts)
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    assert in_a.tolist() == [sum(side == 0 for _, side in merged[:d]) for d in cuts]


def token_bytes(known, ids, side):
    return [(known.bytes_a, known.bytes_b)[side][i] for i in ids]


def plain(known, text):
    """Ids and groups of a text encoded as a whole, and its links; None without tokens."""
    a = known.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = known.b.encode(text) if text else []
    sides = [token_bytes(known, ids, side) for side, ids in enumerate((a, b))]
    raw = (" " + text).encode()
    if not text or any(b"".join(x) != raw for x in sides):
        return [], [], "", []
    ends = [list(accumulate(map(len, x))) for x in sides]
    both, parts = set(ends[0]) & set(ends[1]), []
    for ids, own in zip((a, b), ends):
        parts.append([[]])
        for i, end in zip(ids, own):
            parts[-1][-1].append(str(i))
            if end in both:
                parts[-1].append([])
    written = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(*parts) if x)
    links, j = [], 0
    for i, end in enumerate(ends[0]):
        while True:
            links.append((a[i], b[j]))
            if ends[1][j] >= end:
                break
            j += 1
        j += ends[1][j] == end
    return a, b, written, links


TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "x\ty \n z", "日本 語", "a▁b c", "​ x", "a\xa0 b",
    "<|endoftext|> <s> </s> <0x0A>", "it's  'll", "\0 x", "　全角 x", "a\x1c b", "été x",
    "x" * 3000, "1234567890 " * 40, "᠎ y", "﻿ z", "   lead", "trail   ", "!?;:  ()[]"]


def test_cut_texts_have_the_ids_of_whole_texts(known, monkeypatch):
    monkeypatch.setattr(al, "KNOWN_UNITS", 300)  # so that units are forgotten on the way
    texts = TEXTS + [t or "" for _, t in fixtures.texts()[:130]]
    for at in range(0, len(texts), 9):
        some = texts[at:at + 9]
        found = al.align(known, some)
        ends = np.cumsum(found.n_a), np.cumsum(found.n_b)
        for n, text in enumerate(some):
            a, b, _, _ = plain(known, text)
            assert found.a[ends[0][n] - found.n_a[n]:ends[0][n]].tolist() == a, text
            assert found.b[ends[1][n] - found.n_b[n]:ends[1][n]].tolist() == b, text


def expected(known, texts):
    """Rows of the query, by document."""
    found = [plain(known, t or "") for t in texts]
    counts = Counter(link for _, _, _, links in found for link in set(links))
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (len(a), len(b), written.count(";") + 1 if written else 0, len(links),
         sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(written.encode()).hexdigest() if written else "")
        for a, b, written, links in found]


@pytest.mark.parametrize("head", [0, 60, al.HEAD_PAIRS])
def test_rows_against_the_plain_version(spark, odd, known, paths, head):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text")
    rows = al.alignment_scores(docs, *paths, head_pairs=head).collect()
    given = fixtures.texts()
    want = sorted((str(d), *x) for (d, _), x in zip(given, expected(known, [t for _, t in given])))
    assert sorted(
        (str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
         r.groups_sha256) for r in rows) == want


def test_odd_texts_through_spark(spark, known, paths):
    docs = spark.createDataFrame(
        [(n, t) for n, t in enumerate(TEXTS)] + [(99, None)], "doc_id long, text string")
    rows = al.alignment_scores(docs, *paths).orderBy("doc_id").collect()
    want = expected(known, [*TEXTS, None])
    assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
            for r in rows] == want
    assert rows[-1].groups_sha256 == "" and sum(r.n_a > 0 for r in rows) > 15


def test_groups_and_links_of_documents(spark, known, paths):
    docs = spark.createDataFrame(
        [(1, "Some words, überall"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in al.align_documents(docs, *paths).collect()}
    a, b, written, links = plain(known, "Some words, überall")
    assert ";".join(
        ",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in found[1].groups) == written
    assert [(a[x.a], b[x.b]) for x in found[1].links] == links
    assert found[2].groups == found[2].links == []


def test_packed_pairs_round_trip():
    values = np.array([3, 9, 2**40, 0, 1, 7], np.int64)
    column = al.packed(values, np.array([3, 0, 2, 1]))
    back, sizes = al.unpacked(column)
    assert back.tolist() == values.tolist() and sizes.tolist() == [3, 0, 2, 1]


def test_query_has_one_row_per_document(spark, odd):
    rows = QUERIES["op13_alignment"](spark, odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in fixtures.texts())
