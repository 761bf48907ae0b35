"""Field spans that go on past the fixed patterns stay."""

from tallywatch.llm import secret_scan


class Tagged:
    def __init__(self, *spans):
        self.found = [(a, b, secret_scan.FIELD) for a, b in spans]

    def spans(self, text):
        return self.found


def test_field_spans_past_a_pattern_stay():
    text = "password=abcdef!ghijk9 and token=ghijkl and zz99"
    base = [(0, 15, "assign"), (27, 39, "assign")]
    assert secret_scan.base_spans(text) == base
    past, within, alone = (9, 22), (33, 39), (44, 48)
    found = secret_scan.all_spans(text, Tagged(past, within, alone))
    assert found == sorted(base + [(*past, secret_scan.FIELD), (*alone, secret_scan.FIELD)])
    # one run over two matches and the words between
    run = secret_scan.all_spans(text, Tagged((9, 39)))
    assert (9, 39, secret_scan.FIELD) in run and len(run) == 3
