"""Fill-in-the-middle: round trips, the arranged texts, odd rows."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import infill

PARTS = st.text(alphabet="ab<>PSM é😀\n", max_size=20)


@settings(max_examples=300, deadline=None)
@given(PARTS, PARTS, PARTS, st.sampled_from(["psm", "spm"]))
def test_round_trip(a, b, c, form):
    text = (a + b + c).encode()
    lo, hi = len(a.encode()), len((a + b).encode())
    if any(m in text for m in infill.Infill().marks):
        form = "plain"
    pieces, buffers = infill.arrange(text, lo, hi, form)
    out = b"".join(infill.stream(pieces, buffers))
    want = {"plain": a + b + c, "psm": f"<P>{a}<S>{c}<M>{b}", "spm": f"<S>{c}<P>{a}<M>{b}"}[form]
    assert out.decode() == want
    back = infill.unarrange(out, form)
    assert b"".join(infill.stream(back, (out, b""))) == text
    assert infill.digest(pieces, buffers) == hashlib.sha256(out).hexdigest()


def test_texts_and_odd_rows(spark):
    rows = [(i, "a" * i + "é😀 b\r\n" * (i % 5), "x", "y") for i in range(300)]
    rows += [(400, None, "x", "y"), (401, "", "x", "y"), (None, "no id", "x", "y"), (402, "has <S> in it", "x", "y"),
             (7, rows[7][1], "x", "y"), (7, rows[7][1], "x", "y"), (403, "long é " * 100_000, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, form string")
    made = infill.restore(infill.transform(df, keep=[infill.F.col("text")])).collect()
    assert len(made) == len(rows)
    forms = {"plain": 0, "psm": 0, "spm": 0}
    for r in made:
        forms[r.form] += 1
        text = r.text or ""
        assert r.restored == text and r.n == len(text)
        if r.form == "plain":
            assert r.output == text and r.prefix_chars is None and r.middle_chars is None
        else:
            a, b = r.prefix_chars, r.prefix_chars + r.middle_chars
            pre, mid, suf = text[:a], text[a:b], text[b:]
            assert r.output == (f"<P>{pre}<S>{suf}<M>{mid}" if r.form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}")
    assert all(forms.values())
    said = {(r.doc_id, r.n): r for r in infill.digests(df).collect()}
    for r in made:
        d = said[(r.doc_id, r.n)]
        assert d.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert d.restored_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert infill.digests(df.limit(0)).collect() == []
