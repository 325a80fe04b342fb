import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from textloom.llm import merkle, queries

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(r, text):
    return h(*[coded(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def tree(nodes):
    """(top, proofs): per node its list of (left, right) from the bottom up."""
    proofs, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for proof, at in zip(proofs, where):
            run, k = runs[at // 16], at % 16
            proof.append(("".join(run[:k]), "".join(run[k + 1 :])))
        where = [at // 16 for at in where]
        nodes = [h(*run) for run in runs]
    return (nodes[0] if nodes else None), proofs


def plain(rows):
    first = lambda x: (x is not None, x)
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r["source"] == s), key=lambda r: (first(r["doc_id"]), leaf(r, r["text"]))) for s in sources]
    trees = [tree([leaf(r, r["text"]) for r in g]) for g in groups]
    root, upper = tree([t[0] for t in trees])
    out = []
    for group, (subroot, proofs), above in zip(groups, trees, upper):
        for r, proof in zip(group, proofs):
            proof = proof + above
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = text.translate(UPPER)
            folded = leaf(r, text)
            for left, right in proof:
                folded = h(left, folded, right)
            siblings = h(*[left + right for left, right in proof])
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, root, siblings, folded, folded == root))
    return sorted(out, key=repr)


def same(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == plain(rows)
    return got


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_a_plain_tree(spark, sf):
    path = f"/root/testdata/sf{sf}"
    rows = spark.read.parquet(f"{path}/documents.parquet").collect()
    got = same(queries.op11_merkle_manifest(spark, path), rows)
    assert len(got) == len(rows) and 0 < sum(not r[-1] for r in got) < len(rows)


def test_tall_and_odd_trees(spark):
    """A group of 300 rows (three levels), groups of 1, 16 and 17, odd and
    repeated rows, 20 groups over two upper levels."""
    rows = [(i, f"Text {i}", "en", "tall", i) for i in range(300)]
    rows += [(i, None, None, f"g{i % 17}", None) for i in range(300, 340)]
    rows += [(i, "Ä Ö a", "de", "sixteen", 5) for i in range(16)]
    rows += [(7, "Same", "de", "same", 1)] * 40
    rows += odd.ROWS
    docs = odd.documents(spark, rows)
    same(merkle.audit(docs.repartition(7)), docs.collect())


def test_empty_table_and_single_row(spark):
    assert merkle.audit(odd.empty(spark)).count() == 0
    one = odd.documents(spark, [(5, "A", None, None, None)])
    same(merkle.audit(one), one.collect())


def test_requests_go_down_alone(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(900)]
    docs = odd.documents(spark, rows)
    leaves = docs.select(F.col("source").alias("group"), F.col("doc_id").alias("id"), F.md5("text").alias("digest"))
    manifest = merkle.build(leaves)
    asked = spark.createDataFrame([(0, 0), (0, 299), (2, 17), (2, 17), (9, 9)], "tree long, idx long")
    got = merkle.prove(manifest, asked).withColumn("folded", merkle.fold(F.col("digest"), F.col("proof"))).collect()
    assert sorted((r["tree"], r["idx"]) for r in got) == [(0, 0), (0, 299), (2, 17)]
    assert all(r["folded"] == manifest.root and len(r["proof"]) == 4 for r in got)
    assert sorted(r["id"] for r in got) == [0, 53, 897]
