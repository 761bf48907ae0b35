"""Packing and quality scores against plain versions."""

import math
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywatch.llm import packing, quality
from tallywatch.llm.common import MIX, table

FULL = (1 << 64) - 1


def plain_bins(sizes, lengths):
    """Best fit in falling size; among equal rooms the bin that was changed last."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins = []  # [room, last change, positions]
    for turn, at in enumerate(order):
        open_ = [b for b in bins if b[0] >= sizes[at]]
        if open_:
            chosen = min(open_, key=lambda b: (b[0], -b[1]))
        else:
            costs = []
            for length in lengths:
                if length >= sizes[at]:
                    room = length - sizes[at]
                    for later in order[turn + 1:]:
                        if sizes[later] <= room:
                            room -= sizes[later]
                    filled = length - room
                    least = min(x for x in lengths if x >= filled)
                    costs.append(((least + packing.SEQUENCE_COST) / filled, length))
            chosen = [min(costs)[1], 0, []]
            bins.append(chosen)
        chosen[0] -= sizes[at]
        chosen[1] = turn
        chosen[2].append(at)
    return sorted(
        (min(x for x in lengths if x >= sum(sizes[i] for i in held)), held) for _, _, held in bins)


@settings(max_examples=300, deadline=None)
@given(sizes=st.lists(st.integers(1, 64), max_size=70),
       lengths=st.sampled_from([(64,), (16, 64), (8, 16, 32, 64), (10, 25, 64)]))
def test_bins_equal_plain_best_fit(sizes, lengths):
    assert sorted(packing.pack(sizes, lengths)) == plain_bins(sizes, lengths)


def mixed(value):
    value ^= value >> 30
    value = value * MIX[0] & FULL
    value ^= value >> 27
    value = value * MIX[1] & FULL
    return value ^ value >> 31


def plain_buckets(text):
    """Buckets of all words and pairs of neighbours, one by one."""
    words = [xxhash.xxh64_intdigest(w) for w in (text or "").encode().split()]
    out = []
    for gram in [(w,) for w in words] + list(zip(words, words[1:])):
        value = 0
        for word in gram:
            value = (value * MIX[0] + word) & FULL
            value ^= value >> 29
        out.append(mixed(value) % quality.BUCKETS)
    return out


def test_likelihood_ratio_equals_plain_counts(spark, odd):
    docs = [(r.doc_id, r.text) for r in table(spark, odd, "documents").collect()]
    # both classes among documents that pass the base rules; 3 has both labels
    rows = [(i, int(i % 3 > 0)) for i in range(60)] + [(3, 1), (None, 1), (5, None), (10**9, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    trusted = {i: int(i % 3 > 0) for i in range(60)}
    raw, target = Counter(), Counter()
    for doc, text in docs:
        found = plain_buckets(text)
        raw.update(found)
        if doc is not None and trusted.get(doc) == 1:
            target.update(found)

    def log_share(counts, bucket):
        return math.log((counts[bucket] + 1) / (counts.total() + quality.BUCKETS))

    def ratio(text):
        found = plain_buckets(text)
        return sum(log_share(target, b) - log_share(raw, b) for b in found) / max(1, len(found))

    frame = table(spark, odd, "documents").select("doc_id", "text")
    model = quality.fit_quality(frame, labels)
    rows = quality.score_quality(frame.withColumn("same", frame.text), model).collect()
    assert len(rows) == len(docs) and target.total() > 0
    for row in rows:
        assert row.llr == pytest.approx(ratio(row.same), abs=1e-9)
        assert row.kept == (not row.base_failed and row.llr >= model.threshold)

    known = defaultdict(list)
    for row in rows:
        if row.doc_id in trusted and not row.base_failed:
            known[row.doc_id].append(row.llr)
    scores = {doc: min(found) for doc, found in known.items()}

    def hits(cut):
        """Sum of both classes' hit rates."""
        good = [s >= cut for d, s in scores.items() if trusted[d] == 1]
        bad = [s < cut for d, s in scores.items() if trusted[d] == 0]
        return sum(good) / len(good) + sum(bad) / len(bad)

    cuts = [-math.inf, *scores.values(), max(scores.values()) + 1]
    assert hits(model.threshold) == pytest.approx(max(map(hits, cuts)))
