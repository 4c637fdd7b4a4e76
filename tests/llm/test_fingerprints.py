import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from marlstone.llm import fingerprints as fp

from .conftest import words

texts = st.text(max_size=60)


@settings(max_examples=150, deadline=None)
@given(texts, texts, st.integers(0, 60), st.integers(0, 60))
def test_spans_and_extensions_equal_brute_force(a, b, i, j):
    pa, pb = fp.Prefixes(a), fp.Prefixes(b)
    i, j = min(i, len(a)), min(j, len(b))
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    assert fp.longest_common_extension(pa, i, pb, j) == n
    assert fp.spans_equal(pa, i, pb, j, n) and not fp.spans_equal(pa, i, pb, j, n + 1)


@settings(max_examples=150, deadline=None)
@given(texts, texts)
def test_spliced_hashes_are_those_of_the_text(a, b):
    keep, take = len(a) - len(a) // 2, min(len(a) // 2, len(b))
    spliced = fp.parts(fp.Spliced(fp.Prefixes(a), keep, fp.Prefixes(b), take))
    assert spliced == fp.parts(fp.Prefixes(a[:keep] + b[:take]))
    assert fp.decoded(fp.encoded(spliced)) == spliced


def test_blocks_of_long_texts():
    text = "".join(chr(97 + i * i % 26) for i in range(3 * fp._BLOCK + 17))
    p = fp.Prefixes(text)
    at = fp._BLOCK - 3
    assert p.span(at, at + 50) == fp.Prefixes(text[at : at + 50]).span(0, 50)


def expected(rows):
    out = []
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        change = len(t) // 2
        edited = t[: len(t) - change] + after[:change]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), fp.encoded(fp.parts(fp.Prefixes(t))), fp.encoded(fp.parts(fp.Prefixes(edited)))))
    return sorted(out)


def test_query_equals_brute_force(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id", ascending=False).collect()]
    for buckets in (1, 7):
        got = fp.fingerprint_documents(docs, buckets=buckets).collect()
        assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got) == expected(rows)
        for r in got:
            assert r.near_edited == fp.likeness(r.fingerprint, r.edited_fingerprint)
            assert r.n_chars < 2 or r.near_edited > 0.4
            assert 0 <= r.near_next <= 1


def test_likeness():
    f = lambda t: fp.encoded(fp.parts(fp.Prefixes(t)))
    assert fp.likeness(f(""), f("")) == 1 and fp.likeness(f("a"), f("")) == 0
    assert fp.likeness(f("abc" * 50), f("abc" * 50)) == 1
    assert 0.8 < fp.likeness(f("q" + "abc" * 500), f("abc" * 500)) < 1


def edited(text, edits, seed):
    """With single words changed, spread over the whole text."""
    r, w = random.Random(seed), text.split(" ")
    for k in range(edits):
        w[min(len(w) - 1, 3 + k * (len(w) - 6) // max(1, edits - 1))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def test_scattered_edits_keep_what_lies_between():
    f = lambda t: fp.encoded(fp.parts(fp.Prefixes(t)))
    text, other = words(3, 600), words(4, 600)
    for edits, least in ((2, 0.95), (5, 0.88), (12, 0.7)):
        for seed in range(5):
            near = edited(text, edits, seed)
            assert least < fp.likeness(f(text), f(near)) < 1
            assert fp.likeness(f(near), f(text)) == fp.likeness(f(text), f(near))
    assert fp.likeness(f(text), f(other)) < 0.05
    assert fp.likeness(f(text), f(text + " " + text)) <= 0.5
    # Moved text counts, too.
    assert fp.likeness(f(text + other), f(other + text)) > 0.9


def test_near_next_of_scattered_edits(spark):
    text = words(5, 600)
    df = spark.createDataFrame([(2, text), (1, edited(text, 3, 1))], "doc_id long, text string")
    assert all(0.9 < r.near_next < 1 for r in fp.fingerprint_documents(df, buckets=1).collect())


def test_spans_of_long_and_monotone_texts():
    text = words(6, 20_000)
    for t in ("a" * 200_000, "ab" * 70_000, text, "a" * 70_000 + text):
        p = fp.parts(fp.Prefixes(t))
        assert int((fp._unpacked(p[4]) & fp.np.uint64(0xFFFF)).sum()) == len(t) and 5 * len(t) >= 9 * (len(p[4]) - 10)
        at = len(t) // 3
        assert p == fp.parts(fp.Spliced(fp.Prefixes(t[:at] + "x"), at, fp.Prefixes(t[at:] + "y"), len(t) - at))


def test_odd_rows(odd, empty, spark):
    rows = fp.fingerprint_documents(odd).collect()
    assert len(rows) == 12 and [r.n_chars for r in rows if r.doc_id == 1] == [0]
    same = {r.fingerprint for r in rows if r.n_chars == 33}
    assert len(same) == 1
    assert fp.fingerprint_documents(empty).collect() == []
    one = spark.createDataFrame([(1, "alone")], "doc_id long, text string")
    assert fp.fingerprint_documents(one).first().edited_sha256 == hashlib.sha256(b"aloal").hexdigest()
