import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bankspark.llm import merkle
from tests.llm.util import odd_rows, similar_docs


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Root of a list of digests and each one's siblings by level."""
    paths, level, own = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for j, i in enumerate(own):
            run = i // 16 * 16
            paths[j].append(("".join(level[run:i]), "".join(level[i + 1:run + 16])))
        level = [h(*level[i:i + 16]) for i in range(0, len(level), 16)]
        own = [i // 16 for i in own]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0], h(*map(field, r))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, inner = {}, {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subs[g], inner[g] = climb([leaf for _, leaf in groups[g]])
    root, outer = climb([subs[g] for g in names])
    return sorted(((i, g, leaf, subs[g], root, tuple(inner[g][k] + outer[j])) for j, g in enumerate(names) for k, (i, leaf) in enumerate(groups[g])), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, place string, level0 string, digest string, path string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


def got(rows):
    return sorted(((r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in rows.collect()), key=repr)


def awkward():
    rows = [(i, "s" + str(len(t or "")), "en", None, t) for i, t in odd_rows()]
    rows += [(i, "big" if i % 3 else None, None, i, t) for i, t in similar_docs(90)]
    return rows + [(7, "é", "fr", -1, "É"), (8, "Z", None, 3, None), (9, "z", "", 0, ""), (10, "", "x", 1, "0")]


def test_equals_brute_force(spark):
    rows = awkward()
    found = got(merkle.manifest(frame(spark, rows).repartition(5)))
    assert found == brute(rows) and len({r[4] for r in found}) == 1


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_at_the_fanout(spark, n):
    rows = [(i, "one", "en", 1, str(i)) for i in range(n)]
    assert got(merkle.manifest(frame(spark, rows))) == brute(rows)


def test_groups_of_many_blocks(spark, monkeypatch):
    """Blocks of one level: the root recurses through several rounds of blocks, in sources and over them."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    monkeypatch.setattr(merkle, "BROADCAST_PATHS", 0)
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 0)
    rows = [(i, f"s{min(i // 3, 20)}", "en", 1, str(i)) for i in range(700)]
    assert got(merkle.manifest(frame(spark, rows).repartition(4))) == brute(rows)


def test_more_than_a_block(spark):
    rows = [(i, "a" if i < 4200 else "b", "en", 1, str(i)) for i in range(4300)]
    assert got(merkle.manifest(frame(spark, rows).repartition(4))) == brute(rows)


def test_changes_are_found(spark):
    rows = awkward()
    docs = frame(spark, rows).withColumn("text", F.col("text"))
    other = merkle.digest(*[merkle.field(F.col(c) if c != "text" else F.concat("text", F.lit("!"))) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    seen = merkle.manifest(docs, carry={"seen": F.when(F.col("text").isNotNull(), other)})
    for r in merkle.verify(seen.withColumn("seen", F.coalesce("seen", "leaf")), "seen").collect():
        assert r.verified == (r.seen == r.leaf)
    assert merkle.verify(seen).filter("not verified or verified is null").count() == 0


def test_lower_ascii_leaves_other_letters(spark):
    r = spark.createDataFrame([("ABCÉİ z",), ("ABC",), (None,)], "t string").select(merkle.lower_ascii(F.col("t"))).collect()
    assert [x[0] for x in r] == ["abcÉİ z", "abc", None]


def test_empty_table(spark):
    assert merkle.manifest(frame(spark, awkward()).limit(0)).collect() == []


def test_query_tampers_every_fifth(spark, sf_dir):
    from bankspark.llm import queries

    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    found = queries.QUERIES["op12_merkle_manifest"](spark, sf_dir).collect()
    want = {r[0]: r for r in brute([(d.doc_id, d.source, d.lang, d.n_chars, d.text) for d in docs.values()])}
    assert len(found) == len(docs)
    for r in found:
        d, w = docs[r.doc_id], want[r.doc_id]
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and d.text != d.text.translate(low)
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (*w[2:5], h(*[a + b for a, b in w[5]]))
        assert r.verified == (not changed) and (r.folded_root == r.root) == r.verified
