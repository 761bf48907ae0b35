"""The operators' own parts against plain versions."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import fixtures
from tallywatch.llm import (
    bpe, html_text, lm, neardup, packing, quality, repeats, secret_scan, topk, toxicity,
)
from tallywatch.llm.common import stored


# --- toxicity


def test_noisy_or():
    p = np.array([0.1, 0.5, 0.9])
    assert toxicity.noisy_or(np.log(p / (1 - p))) == pytest.approx(1 - 0.9 * 0.5 * 0.1)
    assert toxicity.noisy_or(np.array([])) == 0.0
    assert toxicity.noisy_or(np.array([800.0, -800.0])) == 1.0


def test_offending_sentences_are_located(spark):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        lines = [fixtures.sentence(draw, 8) for _ in range(6)]
        if i % 2:
            lines[i % 6] = "You are vile. "
        rows.append((i, " ".join(lines)))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs.withColumnRenamed(
        "doc_id", "doc_id").withColumn("copy", docs.text), model).collect()}
    for i in range(1, 400, 2):
        assert any("vile" in found[i].copy[s.start:s.end] for s in found[i].sentences)


def test_one_class_only(spark):
    docs = spark.createDataFrame([(1, "a b. c"), (2, None)], "doc_id long, text string")
    none = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score < 0.5 for r in toxicity.score_toxicity(docs, none).collect()] == [True, True]


# --- secrets


def random_model(seed):
    draw = np.random.default_rng(seed)
    steps = draw.normal(size=(3, 3))
    steps[0, 2] = secret_scan.FORBIDDEN
    return secret_scan.SecretModel(
        draw.normal(size=(5, secret_scan.BUCKETS, 3)) * [1, 0.6, 0.6],
        draw.normal(size=(8, 3)) + [3, 0, 0], steps, frozenset())


@pytest.mark.parametrize("seed", range(12))
def test_pruned_decoding_equals_full_search(seed):
    draw = random.Random(seed)
    tagger = secret_scan.Tagger(random_model(seed))
    for _ in range(20):
        tokens = draw.choices(["abc", "=", "a1b2", "99", "Zq", "é"], k=draw.randint(1, 7))
        scores = tagger.emissions(tokens, " ".join(tokens))

        def value(path):
            total = scores[0][path[0]] + (secret_scan.FORBIDDEN if path[0] == 2 else 0)
            return total + sum(
                tagger.model.steps[a, b] + scores[t + 1][b]
                for t, (a, b) in enumerate(zip(path, path[1:])))

        best = max(map(value, itertools.product(range(3), repeat=len(tokens))))
        found = tagger.tags(tokens, " ".join(tokens))
        assert value(tuple(found)) == pytest.approx(best)


def test_field_learns_the_patterns_and_finds_more():
    draw = random.Random(2)
    windows = []
    for _ in range(250):
        value = "".join(draw.choices("0123456789abcdef", k=draw.choice([18, 32, 40])))
        line = f"{' '.join(draw.choices(fixtures.WORDS, k=8))} password={value} " \
               f"{' '.join(draw.choices(fixtures.WORDS, k=8))}"
        windows += secret_scan.training_windows(line)
        windows += secret_scan.training_windows(
            f"{' '.join(draw.choices(fixtures.WORDS, k=8))} call {draw.randrange(10**15)} now")
    tagger = secret_scan.Tagger(secret_scan.fit_windows(windows))
    text = "the phrase passphrase=7602ad27cf5550de1c of it"
    assert [s[2] for s in secret_scan.all_spans(text, tagger)] == [secret_scan.FIELD]
    assert secret_scan.all_spans(" ".join(fixtures.WORDS), tagger) == []


def test_mask_keeps_rows_and_columns(spark):
    docs = fixtures.documents(spark)
    masked = secret_scan.mask_secrets(docs)
    assert masked.columns == docs.columns
    rows = {r.doc_id: r.text for r in masked.collect()}
    assert masked.count() == docs.count()
    assert rows[500] is None
    assert "24be" not in rows[509] and "AKIA" not in rows[509] and "here" in rows[509]
    assert rows[3] == dict(fixtures.texts())[3]


# --- byte-level BPE


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers as public

    return bpe.Codec(bpe.read_ranks(public.path(bpe.RANK_FILE)), public.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    import public_tokenizers as public
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.sampled_from(list("abeinst 's12.!\n\té日\U0001f642\x1c　́")),
                    max_size=40))
def test_units_give_the_library_s_ids(codec, library, text):
    known = bpe.UnitCache(codec, as_text=False)
    units = bpe.units_of(text)
    known.fill([units])
    assert known.coded(units) == library.encode_ordinary(text)


def test_long_words_are_cut_where_no_token_spans(codec, library):
    word = ("ab" * 40 + "éq" * 30 + "zzxq" * 30).encode()
    assert b"".join(codec.parts(word)) == word
    assert codec.code([word])[0].as_py() == library.encode_ordinary(word.decode())


def test_every_byte_and_empty_lists_are_decoded(codec):
    lists = [codec.byte_ids, codec.byte_ids[:0], codec.byte_ids[::-1], codec.byte_ids[:1]]
    whole = bytes(range(256))
    assert list(bpe.decode_lists(codec, lists)) == [whole, b"", whole[::-1], b"\0"]


def test_words_of_several_queries_keep_their_order(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "QUERY_WORDS", 3)
    words = ["qzx", "a", "unbelievably", "zq", "tokenised", "é日", "qqqq", "xyzzy"]
    found = codec.contract([w.encode() for w in words]).to_pylist()
    assert found == [library.encode_ordinary(w) for w in words]
    assert codec.contract([]).to_pylist() == []


def test_encode_and_decode_documents(spark, codec):
    import public_tokenizers as public

    path = public.path(bpe.RANK_FILE)
    docs = fixtures.documents(spark).select("doc_id", "text", "ids").filter("doc_id is not null")
    coded = bpe.encode_documents(docs, path, public.PATTERN)
    assert sorted(coded.columns) == ["doc_id", "ids"]
    raw = {r.doc_id: bytes(r.raw) for r in bpe.decode_documents(
        coded, path, public.PATTERN).collect()}
    assert raw == {d: (t or "").encode() for d, t in fixtures.texts() if d is not None}


# --- language model


def test_probabilities_sum_to_one():
    words = [b"w%d" % i for i in range(150)]
    counts = np.arange(150, 0, -1).astype(float)
    vocabulary = lm.Vocabulary(words, counts, 20_000, 300)
    model = lm.new_model(vocabulary)
    draw = np.random.default_rng(0)
    stream = np.concatenate([[model.before] * 18, draw.integers(0, 151, 400)])
    lm.train(model, stream)
    begin = list(stream[:60])
    total = sum(
        10 ** lm.log_probabilities(model, np.array(begin + [w]))[-1] for w in range(151))
    assert total == pytest.approx(1.0, abs=1e-5)


def test_training_raises_the_likelihood():
    vocabulary = lm.Vocabulary([b"a", b"b", b"c"], np.array([3.0, 3.0, 3.0]) * 4000, 36_000, 3)
    model = lm.new_model(vocabulary)
    stream = np.array([model.before] * 18 + [0, 1, 2] * 8000)
    before = lm.log_probabilities(model, stream).sum()
    for _ in range(6):
        lm.train(model, stream)
    assert lm.log_probabilities(model, stream).sum() > before * 0.6


def test_scores_do_not_depend_on_the_batch():
    model = lm.new_model(lm.Vocabulary([b"a", b"b"], np.array([9.0, 5.0]), 20, 4))
    stream = np.array([model.before] * 18 + [0, 1, 2, 0, 1] * 4000)
    whole = lm.log_probabilities(model, stream)
    tail = lm.log_probabilities(model, stream[9000:])
    assert whole[9100:] == pytest.approx(tail[100:], abs=1e-4)


# --- near duplicates


def test_sketch_estimates_high_similarity():
    draw = np.random.default_rng(1)
    differ = []
    for _ in range(60):
        shared, own = draw.integers(0, 2**63, 900), draw.integers(0, 2**63, 200)
        a = np.unique(np.concatenate([shared, own[:100]]).astype(np.uint64))
        b = np.unique(np.concatenate([shared, own[100:]]).astype(np.uint64))
        flips = neardup.odd_sketch(neardup.minhash(a)) ^ neardup.odd_sketch(neardup.minhash(b))
        differ.append(int(np.bitwise_count(flips).sum()))
    # similarity 9/11: both sketches differ in about twice the samples that do
    assert max(differ) <= neardup.most_flips(neardup.LEAST_ESTIMATE)
    assert np.mean(differ) == pytest.approx(neardup.most_flips(9 / 11), rel=0.15)


def test_buckets_in_several_blocks_give_all_cross_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rows = [(1, bytes([i]), bytes([i % 2]), [0] * 8) for i in range(40)]
    rows += [(2, bytes([i]), b"x", [0] * 8) for i in range(5)]
    members = spark.createDataFrame(
        rows, "band long, class binary, label binary, sketch array<long>")
    found = {(bytes(r.low), bytes(r.high)) for r in neardup.cross_pairs(members).collect()}
    expected = {
        (bytes([i]), bytes([j])) for i in range(40) for j in range(i) if i % 2 != j % 2}
    assert found == {tuple(sorted(p)) for p in expected}


def test_components_of_a_chain_and_a_star(spark):
    links = [(bytes([i]), bytes([i + 1])) for i in range(30)]
    links += [(bytes([100]), bytes([101 + i])) for i in range(50)]
    found = neardup.components(spark.createDataFrame(links, "low binary, high binary")).collect()
    labels = {bytes(r["class"]): bytes(r["label"]) for r in found}
    assert all(labels[bytes([i])] == bytes([0]) for i in range(31))
    assert all(labels[bytes([101 + i])] == bytes([100]) for i in range(50))


def test_classes_are_joined_by_numbers(spark, monkeypatch):
    """Before, they were joined by 16 byte digests, so every small table that a join sent to the
    executors took a whole page of memory there, and every minimum a sort."""
    made = {}

    def noted(df, label):
        made.setdefault(label, []).append(dict(df.dtypes))
        return stored(df, label)

    monkeypatch.setattr(neardup, "stored", noted)
    found = neardup.near_duplicates(fixtures.documents(spark))
    assert dict(found.dtypes)["component"] == "bigint"
    for label in ("buckets", "pairs", "links", "edges", "labels", "sets"):
        keys = {k: t for types in made[label] for k, t in types.items()
                if k in ("class", "low", "high", "a", "b", "label")}
        assert keys and set(keys.values()) == {"bigint"}
    assert found.filter("n_shingles = 0 and component is not null").isEmpty()


def test_one_row_of_each_component_stays(spark):
    docs = fixtures.documents(spark)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    named = [i for unnamed, i, _ in ids if not unnamed]
    assert set(range(60)) <= set(named) and not set(range(200, 240)) & set(named)
    assert named.count(505) == 0 and {500, 501, 502} <= set(named)
    assert len(ids) == len(set(ids))


# --- pages


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><a href=/>Home</a></header><nav><ul><li>One<li>Two</ul></nav>
<div class="cookie-notice">We use cookies</div>
<article class=post><h1>A &amp; B</h1><p>First <b>bold</b>
 line&nbsp;here<p>Second<br>line <script>var x = "<p>no</p>";</script></p>
<ul><li>x</li><li>y &lt;z&gt;</li></ul><aside>See also</aside>
<div class="comments"><p>Reader</p></div></article>
<form><input value=q><p>Search</p></form><footer>&copy; me</footer></body></html>"""


def test_article_of_a_marked_page():
    assert html_text.main_text(PAGE, []) == "A & B\nFirst bold line here\nSecond line\nx\ny <z>"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain words", "plain words"), ("<p>open", "open"), ("<!-- x", ""), ("a < b", "a < b"),
    ("<p>a<p hidden>b<p>c", "a\nc"), ("<div id=sidebar><div>x</div></div><div>y</div>", "y"),
    ("<p>caf&eacute; &#65;&#x42; &am", "café AB &am"),
    ("<nav>x<article><p>inside</p></article>", "inside"),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</table>", "a b\nc"),
])
def test_odd_pages(page, text):
    assert html_text.main_text(page, []) == text


@settings(max_examples=200, deadline=None)
@given(a=st.lists(st.integers(0, 4), max_size=12), b=st.lists(st.integers(0, 4), max_size=12))
def test_longest_common_lines(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(
            table[i][j + 1], table[i + 1][j])
    found = html_text.common_lines(a, b)
    assert len(found) == table[-1][-1] and found == sorted(set(found))
    rest = iter(b)
    assert all(line in rest for line in (a[i] for i in found))


def test_pages_without_articles_lose_what_neighbours_share(spark):
    frame = "<div>Site name</div>{}<div>Imprint and terms</div>"
    rows = [
        (1, "http://h.org/a/1", frame.format("<p>own one</p><p>more</p>"), "t", "p"),
        (2, "http://h.org/a/2", frame.format("<p>own two</p>"), "t", "p"),
        (3, "http://other.org/a/1", frame.format("<p>alone</p>"), "t", "p"),
        (4, None, "<p>no address</p>", "t", "p"), (None, "http://h.org/b", None, None, None),
        (2, "http://h.org/a/2", frame.format("<p>own two</p>"), "t", "p"),
        (6, "http://[bad", "<p>odd</p>", None, None),
    ]
    found = html_text.extract_pages(fixtures.frame(spark, rows, fixtures.PAGES)).collect()
    texts = sorted((r.page_id or 0, r.text) for r in found)
    assert texts == [
        (0, ""), (1, "own one\nmore"), (2, "own two"), (2, "own two"),
        (3, "Site name\nalone\nImprint and terms"), (4, "no address"), (6, "odd")]


# --- packing


@settings(max_examples=150, deadline=None)
@given(sizes=st.lists(st.integers(1, 64), max_size=60))
def test_bins_are_whole_and_downsized(sizes):
    bins = packing.pack(sizes, (16, 32, 64))
    assert sorted(i for _, held in bins for i in held) == list(range(len(sizes)))
    for length, held in bins:
        filled = sum(sizes[i] for i in held)
        assert filled <= length and not any(filled <= x < length for x in (16, 32, 64))
    # never worse than one bin for each piece
    assert sum(x for x, _ in bins) <= sum(
        next(x for x in (16, 32, 64) if x >= s) for s in sizes)


def test_lengths_are_chosen_together():
    # 40 + 24 fill 64; by itself 40 would waste 24
    assert sorted(packing.pack([40, 24, 30], (32, 64))) == [(32, [2]), (64, [0, 1])]


# --- quality


def test_threshold_separates_and_keeps_ties():
    scores, good = np.array([0.0, 0.1, 0.4, 0.5, 0.5]), np.array([0, 0, 1, 1, 1])
    assert 0.1 < quality.best_threshold(scores, good) <= 0.4
    assert quality.best_threshold(scores, np.ones(5)) == float("-inf")
    same = quality.best_threshold(np.array([0.3, 0.3]), np.array([0, 1]))
    assert same in (float("-inf"), 0.3)


def test_without_labels_only_base_rules_reject(spark, odd):
    docs = fixtures.documents(spark)
    model = quality.fit_quality(docs, fixtures.frame(spark, [], fixtures.LABELS))
    rows = quality.score_quality(docs.select("doc_id", "text", "kept"), model).collect()
    assert all(r.kept != r.base_failed for r in rows)


# --- repeats


@settings(max_examples=120, deadline=None)
@given(contexts=st.lists(
    st.lists(st.sampled_from(b"ab\x00\xfe"), min_size=5, max_size=30).map(bytes),
    min_size=1, max_size=6))
def test_repeated_starts_of_contexts(contexts):
    whole = [c + b"pad" for c in contexts]
    strings = [[c[i:i + 8] for i in range(len(c) - 7)] for c in whole]
    flat = [s for own in strings for s in own]
    assert [f.tolist() for f in repeats.repeated_starts(whole, 8)] == [
        [flat.count(s) > 1 for s in own] for own in strings]


def test_two_stage_order_is_the_sorted_order():
    draw = random.Random(4)
    text = bytes(draw.choices(b"abc", k=500)) + b"aaaaaa" * 20 + repeats.SEPARATOR
    codes = np.frombuffer(text, np.uint8)
    wanted = np.zeros(len(text), bool)
    wanted[:len(text) - 40] = True
    found = repeats.two_stage_order(text, codes, wanted, 40)
    assert sorted(found.tolist()) == list(range(len(text) - 40))
    keys = [text[i:i + 40] for i in found]
    assert keys == sorted(keys)


def repetitive_rows():
    """(doc_id, text) with passages, periodic texts, copies and characters of several bytes."""
    draw = random.Random(8)
    blocks = ["".join(draw.choices("abcd é", k=draw.randint(60, 260))) for _ in range(8)]
    rows = [(i, "".join(draw.choices(blocks, k=draw.randint(0, 4)))) for i in range(60)]
    rows += [(100, "ab" * 300), (101, "z" * 500), (102, blocks[0] * 3), (103, None), (104, "")]
    return rows + [(105, rows[5][1]), (106, rows[5][1])]


@pytest.mark.parametrize("hot", [1_000_000, 1])
def test_removal_equals_brute_force(spark, monkeypatch, hot):
    from test_queries import removed_bytes

    monkeypatch.setattr(repeats, "HOT_BYTES", hot)
    monkeypatch.setattr(repeats, "SORT_AT_ONCE", 5)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2_000)
    rows = repetitive_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = {r.doc_id: r.text for r in repeats.cut_repeats(docs, 100).collect()}
    raws, gone = removed_bytes([t for _, t in rows], 100)
    for (doc, text), raw, mask in zip(rows, raws, gone):
        kept = bytes(b for b, g in zip(raw, mask) if not g).decode(errors="ignore")
        assert (cut[doc] or "") == kept
        assert (cut[doc] is None) == (text is None)


# --- search


@settings(max_examples=150, deadline=None)
@given(seed=st.integers(0, 10**6), k=st.integers(1, 5))
def test_pruned_search_equals_all_scores(seed, k):
    draw = np.random.default_rng(seed)
    lists, total = [], {}
    for _ in range(int(draw.integers(1, 7))):
        n = int(draw.integers(1, 400))
        rows = np.sort(draw.choice(500, n, replace=False)).astype(np.int32)
        scores = draw.integers(1, 9, n) / 4
        lists.append(topk.Postings(rows, scores))
        for row, score in zip(rows.tolist(), scores.tolist()):
            total[row] = total.get(row, 0.0) + score
    expected = sorted(((s, r) for r, s in total.items()), key=lambda x: (-x[0], x[1]))[:k]
    assert topk.best_rows(lists, k) == expected


def test_several_query_blocks_and_shards(spark, monkeypatch):
    docs = fixtures.documents(spark, 5).select("doc_id", "text")
    queries = docs.filter("doc_id < 40").withColumnRenamed("doc_id", "query_id")
    whole = sorted(map(tuple, topk.top_documents(docs, queries).collect()))
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "SHARD_TOKENS", 900)
    parts = sorted(map(tuple, topk.top_documents(docs.repartition(2), queries).collect()))
    assert [r[:2] for r in whole] == [r[:2] for r in parts]
    assert [r[3] for r in whole] == pytest.approx([r[3] for r in parts])
