import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from bankspark.llm import alignment as al
from tests.llm.util import docs_frame, odd_rows, similar_docs

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
A_NAMES = {i: t for t, i in A.get_vocab().items()}
# The byte-level alphabet, from the tokenizer: what each byte of Latin-1 text becomes.
EXTRA = [
    (30, "Text <|endoftext|> <s> </s> <unk> <0x41> more"), (31, "under▁score"), (32, "tab\there\nand  two   spaces "), (33, " lead"),
    (34, "emoji 😀 and 漢字 naïve Ünïcödé"), (35, "x" * 3000), (36, "a\x00b"), (37, "​﻿"), (None, "null id"),
]


def pieces(text):
    """Per tokenizer the ids and their bytes."""
    symbols = al.byte_symbols()
    ids = A.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(symbols[c] for c in A_NAMES[i]) if all(c in symbols for c in A_NAMES[i]) else A_NAMES[i].encode()) for i in ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    return a, b


def brute(rows):
    """Straight from the definition: spans of bytes, all pairs of tokens compared."""
    out, linked, holders = [], [], Counter()
    for _, text in rows:
        a, b = pieces(text) if text else ([], [])
        raw = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            a, b = [], []
        spans = []
        for tokens in (a, b):
            at, own = 0, []
            for i, x in tokens:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        links, j = [], 0
        for i, s, e in spans[0]:
            while j < len(spans[1]) and spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, shared, left = [], 0, [list(own) for own in spans]
        for own in left:
            own.reverse()
        for end in common:
            ga, gb = [], []
            for own, group in zip(left, (ga, gb)):
                while own and own[-1][2] <= end:
                    group.append(str(own.pop()[0]))
            groups.append(",".join(ga) + "|" + ",".join(gb))
            shared += len(ga) * len(gb)
        linked.append(links)
        holders.update(set(links))
        out.append([len(a), len(b), len(groups), len(links), shared, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    best = defaultdict(int)
    for (i, _), n in holders.items():
        best[i] = max(best[i], n)
    return sorted(((r[0], *o, sum(holders[x] == best[x[0]] for x in ls), sum(holders[x] for x in ls)) for r, o, ls in zip(rows, out, linked)), key=repr)


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "n_best", "count_sum"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def test_equals_brute_force(spark):
    rows = odd_rows() + EXTRA + [(100 + i, t) for i, t in similar_docs(60)]
    found = got(al.count_links(docs_frame(spark, rows).repartition(3)))
    assert found == brute(rows)
    by = {r[0]: r for r in found}
    assert by[31][1:] == (0, 0, 0, 0, 0, "", 0, 0) and by[30][1] > 8 and by[34][4] > 5


def test_chunks_do_not_change_counts(spark):
    rows = [(i, t) for i, t in similar_docs(50)] + [(60, None), (61, "")]
    docs = docs_frame(spark, rows).repartition(2)
    assert got(al.count_links(docs, chunk_bytes=1)) == got(al.count_links(docs)) == brute(rows)


def test_query(spark, sf_dir):
    from bankspark.llm import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(queries.QUERIES["op13_token_alignment"](spark, sf_dir)) == brute(rows)


def test_links_of_single_texts(spark):
    rows = [(1, "unbelievable tokenization"), (2, None), (2, "naïve 漢字"), (3, "▁")]
    for r in al.align(docs_frame(spark, rows)).collect():
        text = dict(rows[:1] + rows[2:])[r.doc_id]
        if not r.a:
            assert r.doc_id in (2, 3) and not (r.b or r.overlaps or r.shared)
            continue
        a, b = pieces(text)
        assert [i for i, _ in a] == r.a and [i for i, _ in b] == r.b
        ends_a, ends_b = np.cumsum([len(x) for _, x in a]), np.cumsum([len(x) for _, x in b])
        want = {(i, j): min(ends_a[i], ends_b[j]) - max(ends_a[i] - len(a[i][1]), ends_b[j] - len(b[j][1])) for i in range(len(a)) for j in range(len(b))}
        assert {(x.a, x.b): x.bytes for x in r.overlaps} == {k: v for k, v in want.items() if v > 0}
        assert {(x.a, x.b) for x in r.shared} == {(i, j) for i in range(len(a)) for j in range(len(b)) if r.a_group[i] == r.b_group[j]}


def test_product_equals_dense(spark):
    rnd = np.random.default_rng(5)
    for _ in range(30):
        m, k, n = rnd.integers(0, 9, 3)
        a, b = rnd.random((m, k)) < 0.4, rnd.random((k, n)) < 0.4
        csr = lambda x: al.Csr(np.concatenate([[0], np.cumsum(x.sum(1))]).astype(np.int64), np.nonzero(x)[1], x.shape[1])
        dense = np.zeros((m, n), np.int64)
        for i, j, v in al.product(csr(a), csr(b), block=3):
            dense[i, j] += v
        assert (dense == a.astype(int) @ b.astype(int)).all()
        back = csr(a).transposed()
        assert (back.indptr == csr(a.T).indptr).all() and (back.indices == csr(a.T).indices).all()


def test_long_texts_are_cut_where_nothing_changes(monkeypatch):
    rnd = random.Random(1)
    tok = al.load(None, None, None)
    assert tok.cuts
    texts = ["".join(rnd.choice(["ab ", "  ", "é", "the ", "\n", " x", "ing"]) for _ in range(400)) for _ in range(30)] + [" " * 90, "x" * 90 + " "]
    whole = [tok.sp.encode(t) for t in texts]
    monkeypatch.setattr(al, "LONG_TEXT", 7)
    assert [tok.ids_b(t).tolist() for t in texts] == whole


def test_empty_table(spark):
    docs = docs_frame(spark, EXTRA).limit(0)
    assert al.count_links(docs).count() == 0 and al.align(docs).count() == 0
