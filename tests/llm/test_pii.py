import hashlib
import random
import re
import time

import numpy as np
import pytest

from runledger.llm import pii
from runledger.llm.registered import LLM_QUERIES


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m[0]))


@pytest.mark.parametrize(
    "text",
    ["", "a@b@c.com", "x.y+z%1@a-b.c.d.", "@a.b", "a@b", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255", "0001.2.3.4",
     "4111 1111 1111 1111", "4111111111111112", "4111-1111-1111-1111-1", "+1 (555) 555-0101.", "+1 2", "++12 34 56 789", "é 😀 +4912345678 b@c.de",
     "1 2 3 4 5 6 7 8 9 0 1 2 3", "00000000000000000000", "a" * 3000 + "@b.c", "1" * 3000, "+1" + " " * 500, "1.2.3.45.6.7.8"],
)
def test_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_texts_are_fast():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1 " * 100_000):
        pii.base_spans(text)


def digest(spans):
    return ",".join(f"{pii.KINDS[k]}:{b}:{e}" for b, k, e in spans)


def test_whole_table(spark, sf):
    folder = sf.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = LLM_QUERIES["op10_skip_chain_pii"].run(spark, folder).collect()
    assert len(rows) == len(texts)
    added = 0
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert {*digest(base).split(",")} - {""} <= {*spans}
        added += len(spans) - len(base)
    assert added <= 0.02 * len(rows)


def blank_model(**pairs):
    model = {"unary": np.zeros((len(pii.FEATURES), 5)), **{kind: np.zeros((5, 5)) for kind in pii.EDGES}}
    return model | pairs


def test_ties_make_labels_agree():
    """A token alone unclear takes the label of its repeats."""
    model = blank_model(same=4 * np.eye(5))
    model["unary"][19, 4] = 6.0  # after a token with a plus sign
    g = pii.graph(["+1 5550101 later 5550101"])
    assert len(g.edges["same"]) == 2 and not len(g.edges["like"])
    p = pii.marginals(g, model)
    assert len(p) == 3 and p[2].argmax() == 4 and p[2, 4] > 0.8
    model["same"][:] = 0
    assert pii.marginals(g, model)[2, 4] < 0.5


def test_thirty_repeats_agree_however_far():
    """One form with thirty mentions is a tree: its marginals are exact, the same for all that look alike."""
    rng = np.random.default_rng(5)
    model = blank_model(same=rng.normal(size=(5, 5)) + 2 * np.eye(5))
    model["unary"][:] = rng.normal(size=model["unary"].shape) / 4
    model["unary"][19, 4] += 4
    g = pii.graph(["+1 5550101" + " or 5550101" * 29])
    p = pii.marginals(g, model)[1:]
    u = pii._scores(g.on, model["unary"])[1:]
    sent = np.log(np.exp(u) @ np.exp(model["same"]).T)  # from each mention to each label of the form
    for k in range(30):
        rest = np.exp(sent.sum(axis=0) - sent[k] - sent.sum(axis=0).max())
        want = np.exp(u[k]) * (rest @ np.exp(model["same"]))
        np.testing.assert_allclose(p[k], want / want.sum(), atol=1e-4)
    np.testing.assert_allclose(p[1:], np.repeat(p[1:2], 29, 0), atol=1e-9)


def test_marginals_do_not_depend_on_the_batch():
    rng = np.random.default_rng(6)
    model = blank_model(**{kind: rng.normal(size=(5, 5)) for kind in pii.EDGES})
    model["unary"][:] = rng.normal(size=model["unary"].shape)
    texts = [" ".join(str(rng.integers(10, 40)) + "x@"[rng.integers(2)] * int(rng.integers(2)) for _ in range(n)) for n in (40, 3, 90, 0, 25)]
    whole = pii.marginals(pii.graph(texts), model)
    alone = np.concatenate([pii.marginals(pii.graph([t]), model) for t in texts])
    np.testing.assert_array_equal(whole, alone)


def test_marginals_on_a_tree_are_exact():
    rng = np.random.default_rng(1)
    model = blank_model(**{kind: rng.normal(size=(5, 5)) for kind in pii.EDGES})
    model["unary"][:] = rng.normal(size=model["unary"].shape)
    g = pii.graph(["12 345 6@b x 7890"])
    u = pii._scores(g.on, model["unary"])
    joint = u[0][:, None, None] + u[1][None, :, None] + u[2][None, None, :] + model["chain"][:, :, None] + model["chain"][None]
    p = np.exp(joint - joint.max())
    p /= p.sum()
    got = pii.marginals(g, model)
    np.testing.assert_allclose(got[0], p.sum(axis=(1, 2)), atol=1e-4)
    np.testing.assert_allclose(got[1], p.sum(axis=(0, 2)), atol=1e-4)


def sentence(rng, *things):
    words = [rng.choice(["alpha", "beta", "in", "2019", "of", "37", "gamma", "v2", "delta", "omega"]) for _ in range(30)]
    for thing in things:
        words.insert(rng.randint(0, len(words)), thing)
    return " ".join(words)


def test_finds_what_the_patterns_miss():
    """A phone number run into an address has too many digits for its pattern; plain text stays clean."""
    rng = random.Random(8)

    def number():
        return f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"

    def address():
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))

    known = [sentence(rng, f"call {number()} now", f"at {address()} there", f"x{rng.randint(1, 99)}@mail.example now") for _ in range(300)]
    model = pii.fit(known)
    planted = [sentence(rng, f"call {number()} {address()} now") for _ in range(200)]
    base = [pii.base_spans(t) for t in planted]
    assert not any(kind == 3 for found in base for _, kind, _ in found)
    more = pii.added_spans(planted, base, model)
    hits = sum(any(kind == 3 and b <= t.index("call") + 9 < e + 5 for b, kind, e in found) for t, found in zip(planted, more))
    assert hits >= 0.9 * len(planted)
    clean = [sentence(rng) for _ in range(200)]
    assert not any(pii.added_spans(clean, [pii.base_spans(t) for t in clean], model))


def test_long_texts_in_linear_time():
    """A second or two each; minutes and more if any loop were quadratic."""
    model = blank_model(same=np.eye(5), like=np.eye(5), chain=np.eye(5))
    begun = time.monotonic()
    for text in ("1" + "!" * 1_000_000 + "1", "a" * 1_000_000 + " 1", "a@b.c 12 " * 20_000, "1! " * 20_000):
        pii.added_spans([text], [pii.base_spans(text)], model)
    assert time.monotonic() - begun < 60


def test_edges(spark, frame):
    rows = [(1, None, 4), (2, "", 0), (3, "mail a.b@c.de and a.b@c.de now", 9), (3, "mail a.b@c.de and a.b@c.de now", 9)]
    docs = frame(rows, "doc_id long, text string, n_chars long")
    out = pii.redacted_documents(docs)
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()))
    want = "mail <EMAIL> and <EMAIL> now"
    assert got == [(1, None, None), (2, "", 0), (3, want, len(want)), (3, want, len(want))]
    assert pii.redacted_documents(docs.limit(0)).count() == 0
    assert pii.with_spans(docs.withColumn("All_spans", docs.n_chars), None).count() == 4
