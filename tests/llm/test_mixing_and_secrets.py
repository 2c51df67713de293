"""Operators 8 and 9."""

import base64
import random
import re

from pyspark.sql import functions as F

from tallyload.llm.mixing import SLOTS, mix_slots, mix_sources, permuted
from tallyload.llm.secrets import ASSIGN, KINDS, redact_secrets, secret_scan, span_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mixed_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "B", "ä", "zz", None, ""])
        rows.append((i, " ".join("w" for _ in range(rng.randint(0, 200))), None, source))
    rows += [(1000, None, None, "nothing"), (1001, "", None, "nothing"), (None, "w w w", None, "a"), (5, rows[5][1], None, rows[5][3]),
             (1002, "w " * 30_000, None, "long")]
    return rows


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if w[s] * level > cap * sizes[s]}
        if not full:
            target |= {s: w[s] * level for s in free}
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= full
    return target


def test_mix_meets_targets(documents):
    rows = mixed_rows()
    got = mix_sources(documents(rows), block=8).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) <= 1e-6 * max(1, target[r.source])
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.03 * target[s], 100), (s, taken[s], target[s])
    again = mix_sources(documents(rows[::-1]).repartition(5), block=8).collect()
    key = lambda r: (-1 if r.doc_id is None else r.doc_id, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_edges(documents):
    assert mix_sources(documents([])).collect() == []
    got = mix_sources(documents([(1, None, None, None), (2, " \n", None, "a")])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    one = mix_sources(documents([(1, "a b c d", None, None)]), block=1).collect()[0]
    assert one.target == 6.0 and one.taken == 6


def test_many_tiny_sources_meet_their_targets_and_shards_are_mixed(documents):
    """With the production block: 300 sources of 1 to 10 blocks, at their cap, beside a large one."""
    rows = [(i, "w " * 2000, None, "big") for i in range(400)]
    rows += [(1000 + i, "w " * (64 * (i % 10 + 1)), None, f"s{i:03}") for i in range(300)]
    got = mix_sources(documents(rows)).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 64 for s in target)
    slots = mix_slots(documents(rows)).select("shard", "slot", "source").distinct().collect()
    assert len({(r.shard, r.slot) for r in slots}) == max(r.shard * SLOTS + r.slot for r in slots) + 1  # every slot once
    by_shard = {}
    for r in slots:
        by_shard.setdefault(r.shard, {})[r.slot] = r.source
    share = sum(r.source == "big" for r in slots) / len(slots)
    for shard in list(by_shard.values())[:-1]:
        order = [shard[i] for i in range(SLOTS)]
        big = sum(x == "big" for x in order) / SLOTS
        assert abs(big - share) < 0.08
        changes = sum((a == "big") != (b == "big") for a, b in zip(order, order[1:]))
        assert abs(changes - 2 * SLOTS * big * (1 - big)) < 0.25 * SLOTS * big * (1 - big) * 2


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 64, 1000):
        got = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(9)).alias("x")).collect()
        assert sorted(r.x for r in got) == list(range(n))
    assert [r.x for r in got] != list(range(1000))


SECRET = base64.b64encode(random.Random(7).randbytes(30)).decode()


def secret_rows():
    words = " ".join(["ordinary"] * 40)
    return [(1, 'Token = "abc" secret:token:abcdefgh PASSWORD: "hunter2hunter2" end'),
            (2, "é😀 api_key=ABCDEF123456 AKIA" + "Z" * 16 + " AKIA123 " + "0a1f" * 8),
            (3, words + " " + SECRET + " " + words), (4, None), (5, ""), (None, "passwd=abcdef"), (5, "a" * 24 + "-" + "b" * 24),
            (6, "token = = secret=token=abcdefgh apikey:aaaaaa"), (7, ("word " * 30_000) + "token=zzzzzz"),
            (8, " ".join(["electroencephalographically", "antidisestablishmentarianism", "thisisjustaverylongword"] * 30)),
            (9, "AKIA" + "ABCD" * 4 + "AKIA" + "EFGH" * 4), (10, "secret\x00=abcdef ſecret=abcdef toKen=abcdefg")]


def brute_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN[4:], text, re.I | re.A) if len(m[2]) >= 6]
    spans = [x for x in spans if text[x[0]] != "ſ"]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_base_spans_match_brute_force(documents):
    rows = secret_rows()
    got = secret_scan(documents(rows)).collect()
    assert len(got) == len(rows)
    key = lambda x: (-1 if x[0] is None else x[0], str(x))
    assert sorted([(r.doc_id, [tuple(s) for s in r.base]) for r in got], key=key) == sorted([(i, brute_base(t)) for i, t in rows], key=key)
    for r in got:
        assert [tuple(s) for s in r.spans] == sorted(map(tuple, r.spans)) and set(map(tuple, r.base)) <= set(map(tuple, r.spans))
    assert secret_scan(documents([])).collect() == []


def test_battery_finds_random_runs_and_leaves_words(documents):
    rows = secret_rows()
    found = {r.doc_id: [rows[[i for i, _ in rows].index(r.doc_id)][1][s.s:s.e] for s in r.spans if s.kind == 3]
             for r in secret_scan(documents(rows)).collect() if r.doc_id in (3, 8)}
    assert found == {3: [SECRET], 8: []}


def test_span_text_and_masking(documents):
    rows = secret_rows()
    text = {r.doc_id: r.t for r in secret_scan(documents(rows)).select("doc_id", span_text(F.col("base")).alias("t")).collect()}
    assert text[2] == ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in brute_base(rows[1][1]))
    docs = documents(rows)
    masked = redact_secrets(docs)
    assert masked.columns == docs.columns
    got = {r.doc_id: r.text for r in masked.collect() if r.doc_id not in (5, None)}
    assert got[4] is None
    for i, t in rows:
        if i in got and t:
            want = list(t)
            for a, _, b in brute_base(t):
                want[a:b] = "*" * (b - a)
            if i == 3:
                a = t.index(SECRET)
                want[a:a + len(SECRET)] = "*" * len(SECRET)
            assert got[i] == "".join(want)


def test_battery_recalls_keys_of_every_encoding(documents):
    rng = random.Random(5)
    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    sets = {"base36": digits + lower, "BASE36": digits + lower.upper(), "BASE32HEX": digits + lower.upper()[:22], "base32hex": digits + lower[:22],
            "base58": "".join(c for c in digits + lower + lower.upper() if c not in "0OIl"), "base62": digits + lower + lower.upper()}
    key = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    plain = ["electroencephalographically", "thisisjustaverylongword2024", "src/main/java/org/example/some_module-name", "getResponseFromServerVersion2",
             "INTERNATIONALIZATION_CONSTANT_42", "docs/reference/configuration2/introduction", "very-long-hyphenated-identifier-of-words"]
    rows, want = [], {}
    for name, chars in sets.items():
        for n in (24, 32, 40, 64):
            for before in ("", "usr/local/share/some-long_path/to/keys/"):
                for _ in range(12):
                    want[len(rows)] = (name, n, before, key(chars, n))
                    rows.append((len(rows), f"the key {before}{want[len(rows)][3]} ends"))
    for _ in range(60):
        groups = "-".join(key("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))
        want[len(rows)] = ("uuid", 32, "", groups)
        rows.append((len(rows), f"id {groups}."))
    rows += [(len(rows) + i, " ".join(rng.choice(plain) for _ in range(8))) for i in range(600)]
    hits, wrong = {}, 0
    for r in secret_scan(documents(rows)).collect():
        text = rows[r.doc_id][1]
        if r.doc_id not in want:
            wrong += len(r.spans)
            continue
        name, n, before, secret = want[r.doc_id]
        a = text.index(secret)
        hits.setdefault((name, bool(before)), []).append(any(s.s <= a and a + len(secret) <= s.e for s in r.spans))
    recall = {k: sum(v) / len(v) for k, v in hits.items()}
    assert min(recall.values()) >= 0.8, recall
    assert wrong == 0, wrong
