import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from bankspark.llm import packing
from tests.llm.util import docs_frame, odd_rows, similar_docs


def check(rows, pieces, longest=2048, power=True):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(int)
    for i, t in rows:
        want[(i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]))] += 1
    by_ids = defaultdict(list)
    for (i, ids), n in want.items():
        by_ids[i].append(ids)
    sequences = defaultdict(list)
    tokens = 0
    for p in pieces:
        assert any(len(ids) == p.doc_tokens and zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for ids in by_ids[p.doc_id])
        sequences[p.sequence_id].append((p.offset, p.length))
        tokens += p.length
    assert tokens == sum(len(ids) * n for (_, ids), n in want.items())
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= longest and (not power or at & (at - 1) == 0)
    return sequences


def test_pieces_hold_every_id_once_and_windows_need_no_padding(spark):
    rows = odd_rows() + [(1000 + i, t) for i, t in similar_docs(200)]
    pieces = packing.pack(docs_frame(spark, rows).repartition(3)).collect()
    check(rows, pieces)
    spans = defaultdict(list)
    for p in pieces:
        if p.doc_id == 4:
            spans[p.doc_id].append((p.start, p.length))
    at = 0
    for start, length in sorted(spans[4]):
        assert start == at
        at += length


def test_small_buffer_and_other_tiers(spark):
    rows = similar_docs(150, seed=2)
    check(rows, packing.pack(docs_frame(spark, rows).coalesce(1), tiers=(64, 256), buffer_tokens=1000).collect(), longest=256)


def test_step_groups_hold_windows_of_one_length(spark):
    pieces = packing.pack(docs_frame(spark, similar_docs(300)).coalesce(1), group=2).collect()
    length, group = defaultdict(int), {}
    for p in pieces:
        length[p.sequence_id] += p.length
        group[p.sequence_id] = p.step_group
    kinds = defaultdict(list)
    for s, g in group.items():
        kinds[g].append(length[s])
    assert all(len(set(v)) == 1 and len(v) <= 2 for v in kinds.values())


def test_empty_table(spark):
    assert packing.pack(docs_frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_both_encoders_agree():
    encode = packing.Encoder()
    for text in ["", "Hello, it's 12 o'clock  \n\n x", "É straße ñ", "漢字 <|endoftext|>", "a b", "İx", "tab\t\ttab", "x" * 3000]:
        assert encode(text) == encode.full.encode(text, add_special_tokens=False).ids
