"""Fill-in-the-middle forms against plain string work, and the round trip."""

import hashlib
import re

import fixtures
import pytest

from tallywatch.llm import infill as fim
from tallywatch.llm.queries import ORACLES, QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_form(doc, text):
    """(n, form, prefix, middle, suffix, output) by string slices."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), sha(f"7:{'' if doc is None else doc}")
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", prefix, middle, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", prefix, middle, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_query_on_awkward_rows(spark, odd):
    rows = QUERIES["op12_infill"](spark, odd).collect()
    texts = {d: t or "" for d, t in fixtures.texts() if d is not None}
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        if r.doc_id is not None:
            text = texts[r.doc_id]
            n, form, prefix, middle, output = plain_form(r.doc_id, text)
            assert (r.n, r.form) == (n, form)
            assert r.prefix_chars == (None if prefix is None else len(prefix))
            assert r.middle_chars == (None if middle is None else len(middle))
            assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(text))


def test_query_equals_sql(spark, data):
    import duckdb

    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data}/documents.parquet')")
    expected = connection.execute(ORACLES["op12_infill"]).fetchall()
    rows = QUERIES["op12_infill"](spark, data).collect()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)


def test_documents_round_trip(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    infilled = fim.infill_documents(docs, seed=3, rate=80)
    assert "text" not in infilled.columns
    back = fim.restore_documents(infilled)
    before = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == before
    assert {r.form for r in infilled.collect()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("text", [
    "a", "\n", "\n\n", "a\n", "a\nb", "\na", "<", "a<P\nS>b\n<M", "é\n日\n\U0001f642",
    "<<\n<\nP><", "x\r\ny\x0bz w\n"])
def test_cuts_and_inverse(text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert fim.unit_ends(text) == [len("".join(units[:i + 1])) for i in range(len(units))]
    for first in range(len(units) + 1):
        for second in range(first, len(units) + 1):
            cuts = [len("".join(units[:first])), len("".join(units[:second]))]
            table = fim.PieceTable.of(text).cut(cuts)
            assert [p.end - p.begin for p in table.pieces] == [
                cuts[0], cuts[1] - cuts[0], len(text) - cuts[1]]
            for form in ("psm", "spm"):
                arranged = table.arrange(form)
                assert arranged.restore(form).text() == text
                assert fim.restored(arranged.text(), form).text() == text
                assert arranged.digest() == sha(arranged.text())


def test_cutting_an_arranged_table_counts_its_own_characters():
    table = fim.PieceTable.of("abcdef").cut([2, 4]).arrange("spm")
    assert table.text() == "<S>ef<P>ab<M>cd"
    assert table.cut([4, 9]).text() == table.text()
    assert len(table.cut([4, 9]).pieces) == len(table.pieces) + 2


def test_digests_stream_long_texts(monkeypatch):
    monkeypatch.setattr(fim, "STREAM", 7)
    text = "été 日本語\n" * 50
    found = fim.infill(text, "1")
    assert found.table.digest() == sha(found.table.text())
    assert max(map(len, found.table.stream())) <= 21


def test_rates_decide_shares():
    forms = [fim.infill("a\nb\nc", str(i), rate=30, spm_rate=20).form for i in range(4000)]
    assert forms.count("plain") / 4000 == pytest.approx(0.7, abs=0.03)
    assert forms.count("spm") / 4000 == pytest.approx(0.06, abs=0.02)
