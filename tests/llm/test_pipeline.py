"""The pipeline's stages against brute force, and the driver contract with and without this subpackage."""

import hashlib
import os
import random
import re
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from oracle_compare import compare
from tallyload.llm.components import connected_components
from tallyload.llm.common import Scratch
from tallyload.llm.mixing import mix_slots, mix_sources
from tallyload.llm.quality import quality_scores
from tallyload.llm.secrets import secret_scan

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"


def test_oracle_sql_matches(spark):
    for name in ("op1_embedding_neardup", "op3_substring_dedup", "op10_ngram_jaccard_join"):
        result = compare(spark, SF, [name])[name]
        assert result[0] == "ok", result


def test_contract():
    q, sql = E.queries(), E.oracle_sql()
    assert [sum(k.startswith(f"op{n}_") for k in q) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in q and set(sql) <= set(q)
    assert [name for name, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "secret scans", "mixing sources", "BPE encoding"]


def test_entry_works_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(os.path.join(root, "tallyload"), tmp_path / "tallyload", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q); assert not any(k.startswith('op') for k in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


@pytest.fixture()
def corpus(spark, tmp_path):
    """documents and labels of a small corpus, written as Parquet."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(150):
        w = [word() for _ in range(rng.randint(30, 60))]
        text = " ".join(w) + "." if i % 6 else " | ".join(x.upper() + "!!" for x in w)
        rows.append((i, text, "en", f"s{i % 4}" if i % 3 else "hot", len(text)))
    for i in range(150, 170):  # near copies
        t = rows[7][1].split()
        t[rng.randint(0, 3)] = word()
        rows.append((i, " ".join(t), "en", "hot", 0))
    rows.append((170, rows[8][1] + " token=abcdef123456", "en", "hot", 0))
    rows += [(171, None, None, None, None), (None, rows[9][1], "en", "s1", 0), (172, "", "en", "s1", 0)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    labels = [(i, int(i % 6 != 0), 0) for i in range(150)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def brute_near(texts, k=5):
    sets = {i: {tuple(w[p:p + k]) for p in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
            for i, t in texts.items() for w in [(t or "").lower().split()]}
    label = {i: i for i in sets}
    for _ in range(len(sets)):
        before = dict(label)
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return label
    return label


def test_stages_match_brute_force(spark, corpus, tmp_path):
    def reread(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    key = lambda r: str(tuple(r))
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    one = reread(P.drop_rejected(spark, docs, corpus), "one")
    assert one.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in quality_scores(docs, spark.read.parquet(f"{corpus}/labels.parquet")).collect()}
    kept = [r for r in docs.collect() if scores[r.doc_id] == 1]
    assert sorted(one.collect(), key=key) == sorted(kept, key=key)
    good = [r.doc_id for r in kept if r.doc_id is not None and r.doc_id < 150]
    assert sum(i % 6 != 0 for i in good) >= 120 and sum(i % 6 == 0 for i in good) <= 2

    two = reread(P.keep_one_of_each_group(spark, one, corpus), "two")
    label = brute_near({r.doc_id: r.text for r in kept if r.doc_id is not None})
    assert sorted(two.collect(), key=key) == sorted([r for r in kept if r.doc_id is None or label[r.doc_id] == r.doc_id], key=key)

    three = reread(P.mask_secrets(spark, two, corpus), "three")
    assert three.columns == docs.columns
    spans = {r.doc_id: r.spans for r in secret_scan(two).collect()}
    want = []
    for r in two.collect():
        text = list(r.text) if r.text is not None else None
        for s in spans[r.doc_id]:
            text[s.s:s.e] = "*" * (s.e - s.s)
        want.append(("".join(text) if text is not None else None, *[r[c] for c in docs.columns if c != "text"]))
    assert sorted([(r.text, *[r[c] for c in docs.columns if c != "text"]) for r in three.collect()], key=str) == sorted(want, key=str)
    masked = {r.doc_id: r.text for r in three.collect()}
    assert "abcdef123456" not in (masked.get(170) or "")

    four = reread(P.mix(spark, three, corpus), "four")
    assert four.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in four.groupBy("doc_id").count().collect()}
    for r in mix_sources(three).collect():
        if r.doc_id is not None:
            low = r.taken // r.size if r.size else 0
            assert copies.get(r.doc_id, 0) in (low, low + (1 if r.size and r.taken % r.size else 0))
    assert sorted(four.collect(), key=key) == sorted(P.mix(spark, three, corpus).collect(), key=key)

    five = P.encode(spark, four, corpus)
    library = tokenizers.Tokenizer.from_file(P.vocabulary_path())
    want = sorted((str(r.doc_id), len(library.encode(r.text or "", add_special_tokens=False).ids),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in four.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256) for r in five.collect()) == want


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_judge_rows_not_ids(spark, tmp_path):
    def stage(fn, rows, name):
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/{name}")
        return sorted((tuple(r) for r in fn(spark, spark.read.parquet(f"{tmp_path}/{name}"), "").collect()), key=str)

    doc = lambda i, t, source="s": (i, t, "en", source, 0)
    a, b, c = ("one two three four five six " * 3, "ab cd ef gh ij kl mn " * 3, "qr st uv wx yz " * 4)
    rows = [doc(9, a), doc(9, b), doc(4, b), doc(7, c), doc(7, c), doc(7, c), doc(None, b), doc(None, b), doc(5, ""), doc(5, ""),
            doc(6, None), doc(-3, a + "seven"), doc(9, a + "eight")]
    label = brute_near({k: r[1] for k, r in enumerate(rows) if r[0] is not None})
    first = {g: min((rows[k][0], k) for k in label if label[k] == g)[1] for g in set(label.values())}
    want = [r for k, r in enumerate(rows) if r[0] is None or first[label[k]] == k]
    got = stage(P.keep_one_of_each_group, rows, "near")
    ids = lambda found: sorted((str(r[0]), brute_near({0: r[1], 1: a})[1] == 0) for r in found)
    assert len(got) == len(want) and ids(got) == ids(want)
    assert sum(r[1] == c for r in got) == 1 and sum(r[1] == b for r in got) == 3 and sum(r[0] == 4 for r in got) == 1

    # every source is at least as large as its target, so all of a full source comes, null and repeated ids too
    rows = [doc(None, f"n{i} " * 40, "a") for i in range(60)] + [doc(3, f"r{i} " * 40, "a") for i in range(60)]
    rows += [doc(i, f"w{i} " * 40, "b") for i in range(400)]
    got = stage(P.mix, rows, "mix")
    words = lambda found: {k: sum(len(r[1].split()) for r in found if r[0] == k and r[3] == "a") for k in (None, 3)}
    for k, n in words(rows).items():  # the source is at its cap of two passes
        assert n < words(got)[k] <= 2 * n, (k, n, words(got))


def test_mix_emits_the_taken_words(spark, tmp_path):
    rows = [(i, " ".join(f"{i}w{k}" + " \n"[k % 7 == 0] for k in range(n)), "en", s, 0)
            for i, (s, n) in enumerate([("long", 30_000), ("tiny", 700), *[("many", 90)] * 100])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    taken = {r.doc_id: r.taken for r in mix_sources(docs).collect()}
    assert taken[0] % 30_000
    slots = mix_slots(docs).collect()
    place = {}
    for r in slots:
        assert place.setdefault((r.shard, r.slot), (r.source, r["pass"], r.block)) == (r.source, r["pass"], r.block) and r.slot < 1024
    assert len(set(place.values())) == len(place)
    got, from_slots = dict.fromkeys(taken, 0), dict.fromkeys(taken, 0)
    for r in slots:
        from_slots[r.doc_id] += r.words
    for r in P.mix(spark, docs, "").collect():
        words = r.text.split()
        at = [int(w.split("w")[1]) for w in words]
        assert at == sorted(set(at)) and all(w.startswith(f"{r.doc_id}w") for w in words)
        assert len(words) < len(rows[r.doc_id][1].split()) or r.text == rows[r.doc_id][1]
        got[r.doc_id] += len(words)
    assert got == taken == from_slots


def test_pipeline_of_an_empty_table(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert P.run(spark, d).collect() == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1100)]
    edges += [(5000, i) for i in range(5001, 5100)] + [(None, 3), (4, None), (9, 9), (1000, 1001)]
    label = {x: x for e in edges for x in e if x is not None}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and b is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, Scratch(spark, "test")).collect()}
    real = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: label[x] for x in real}
    assert connected_components(df.where(F.lit(False)), Scratch(spark, "test")).collect() == []
    assert re.match("tallyload-", Scratch(spark, "x").root.rsplit("/", 1)[1])


def test_stages_take_clashing_columns_and_leave_no_tables(spark, corpus, tmp_path):
    names = ["_row", "_cut", "_ranges", "_whole", "_key", "_id", "key", "pass", "Words"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    wide = docs.select("*", *[F.lit(n).alias(n) for n in names])
    for stage in (P.keep_one_of_each_group, P.mask_secrets, P.mix):
        got = stage(spark, wide, corpus)
        plain = stage(spark, docs, corpus)
        assert got.columns == wide.columns
        assert got.select(*docs.columns).exceptAll(plain).count() == plain.exceptAll(got.select(*docs.columns)).count() == 0
        assert got.where(" OR ".join(f"`{n}` <> '{n}'" for n in names)).count() == 0
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(base))
    rows = P.run(spark, corpus).count()
    left = {n for n in set(os.listdir(base)) - before if n.startswith("tallyload-")}
    assert rows and [n.rsplit("-", 1)[0] for n in left] == ["tallyload-pipeline"]
