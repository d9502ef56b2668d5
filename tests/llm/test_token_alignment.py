import functools
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from runledger.llm import token_alignment as t
from runledger.llm.packing import _byte_of_char
from runledger.llm.registered import LLM_QUERIES

A_PATH, B_PATH = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@functools.cache
def loaded():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), _byte_of_char()


def brute_text(text):
    """Tokens of the whole text by the libraries; groups and links from byte ranges."""
    a, b, byte = loaded()
    if not text:
        return None
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids]
    b_ids = b.encode(text)
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None

    def ranges(tokens):
        at, out = 0, []
        for token in tokens:
            out.append((at, at + len(token)))
            at += len(token)
        return out

    ra, rb = ranges(a_bytes), ranges(b_bytes)
    links, j = [], 0
    for i, (begin, end) in enumerate(ra):
        while j and rb[j][0] > begin:
            j -= 1
        while rb[j][1] <= begin:
            j += 1
        k = j
        while k < len(rb) and rb[k][0] < end:
            links.append((a_ids[i], b_ids[k]))
            k += 1
    common = sorted({e for _, e in ra} & {e for _, e in rb})
    groups = []
    left = [list(zip(ids, (e for _, e in rs)))[::-1] for ids, rs in ((a_ids, ra), (b_ids, rb))]
    for end in common:
        parts = []
        for stack in left:
            own = []
            while stack and stack[-1][1] <= end:
                own.append(str(stack.pop()[0]))
            parts.append(",".join(own))
        groups.append("|".join(parts))
    return len(a_ids), len(b_ids), groups, links


def brute(texts):
    own = [brute_text(text) for text in texts]
    counts = Counter(pair for one in own if one for pair in one[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = []
    for one in own:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = one
        best = sum(counts[p] == most[p[1]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return rows



COLUMNS = (*t.MEASURES, "groups_sha256")


@pytest.mark.parametrize("limit", [t.BROADCAST_PAIRS, 0])
def test_whole_table(spark, sf, monkeypatch, limit):
    monkeypatch.setattr(t, "BROADCAST_PAIRS", limit)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = LLM_QUERIES["op11_distinct_text_alignment"].run(spark, sf).collect()
    want = dict(zip([d.doc_id for d in docs], brute([d.text for d in docs])))
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == want and len(rows) == len(docs)


TEXTS = [
    None, "", " ", "  ", "a", "a b", "  a  b ", "a ", "a\n b", "a \n b", "a\t\tb   c", "naïve ü 中文 字 🙂 x", "don't 12 3.4 ½",
    "<|endoftext|> x", "has ▁ sign", "one▁", "\x1c a \x1c", "a\r\n\r\n  b\t c", "x" * 3000, "<0x41> <s> </s> <unk>", "\x00 b",
    "same text here", "same text here", "é ​ z", "a b 　 c", "long " * 700 + " ",
]


def test_texts(frame):
    rows = [(i, text, 1) for i, text in enumerate(TEXTS)] + [(None, "same text here", 1)]
    docs = frame(rows, "doc_id long, text string, key int")
    got = t.align_documents(docs, A_PATH, B_PATH, with_groups=True).collect()
    want = brute([r[1] for r in rows])
    key = {r[0]: w for r, w in zip(rows, want)}
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == key[r.doc_id], TEXTS[r.doc_id or 0]
        assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 or r.groups == r.groups_sha256 == ""
    assert t.align_documents(docs.limit(0), A_PATH, B_PATH).count() == 0


def test_remembers_little(monkeypatch):
    monkeypatch.setattr(t, "REMEMBERED_BYTES", 3 * t.ENTRY_BYTES + 50)
    own = t.Aligner(A_PATH, B_PATH)
    text = "one two three four five one two six one seven two"
    for _ in range(3):
        n_a, groups, links = own.texts([text])[0]
        want = brute_text(text)
        assert (n_a, groups.split(";"), len(links) // 8) == (want[0], want[2], len(want[3]))


def test_a_piece_across_a_space_asks_for_whole_texts():
    own = t.Aligner(A_PATH, B_PATH)
    assert own.b.by_chunk
    own.b.by_chunk = False
    assert own.texts(["a b  c "]) == t.Aligner(A_PATH, B_PATH).texts(["a b  c "])


def test_all_at_once_or_one_by_one():
    together, alone = t.Aligner(A_PATH, B_PATH), t.Aligner(A_PATH, B_PATH)
    alone.learn = lambda chunks: None
    texts = [text for text in TEXTS if text != "has ▁ sign" and text != "one▁"]
    assert together.texts(texts) == alone.texts(texts)
    assert together.texts(TEXTS) == alone.texts(TEXTS)
