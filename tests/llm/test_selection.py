"""URL filter, resampling and tokenizer alignment: brute force and odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from odd_tables import build
from lodeworks.llm import alignment, resampling, url_filter


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# URL filter

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    (None, "/", "block"),
    ("bare.org", None, "block"),
]
URLS = [
    ("https://www.Example.COM/en/1?x=/fr/", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/1#top", "m.example.com", "/en/1", "example.com/en/", "block"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://example.com/", "example.com", "/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("a://x.net/es/://y.com/", "x.net", "/es/://y.com/", "net/es/", "block"),
    ("a://x.net?/es/", "x.net", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("x://ÀB.org:80/\n/é", "Àb.org:80", "/\n/é", None, "allow"),
    ("x://bare.org", "bare.org", "", "bare.org", "block"),
    ("x://" + "a" * 300_000 + "/" + "b" * 300_000, "a" * 300_000, "/" + "b" * 300_000, None, "allow"),
]


def pages_of(spark, rows):
    return spark.createDataFrame(
        [(i, url, "x", "y", "z") for i, url in rows], "page_id long, url string, host string, n string, bad string"
    )


def rules_of(spark, rules=RULES):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def outcomes_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, bad boolean")


def test_urls_and_rules(spark):
    pages = pages_of(spark, [(i, row[0]) for i, row in enumerate(URLS)] + [(3, URLS[3][0]), (None, URLS[1][0])])
    got = url_filter.judge(pages, outcomes_of(spark, []), rules_of(spark)).collect()
    want = Counter((i, *row[1:]) for i, row in enumerate(URLS))
    want += Counter([(3, *URLS[3][1:]), (None, *URLS[1][1:])])
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == want


def shrink(groups):
    """``key -> (n, x, prior)`` to ``key -> mean`` and the strength, one by one."""
    excess = sum((x - n * m) ** 2 - n * m * (1 - m) for n, x, m in groups.values())
    room = sum((n - 1) * n * m * (1 - m) for n, x, m in groups.values())
    k = 10.0 if not room else 1000.0 if excess / room <= 1 / 1001 else max(1.0, room / excess - 1)
    return {key: (x + m * k) / (n + k) for key, (n, x, m) in groups.items()}, k


def test_reputations_match_brute_force(spark):
    rng = random.Random(5)
    hosts = [f"h{i}.d{i % 7}.{'co.uk' if i % 3 else 'org'}" for i in range(40)] + ["10.0.0.1", "one", "u@x.d1.org:8"]
    share = {h: rng.choice((0.02, 0.5, 0.98)) for h in hosts}
    rows, outcomes = [], []
    for i in range(1500):
        host = hosts[0] if rng.random() < 0.4 else rng.choice(hosts)
        rows.append((i, f"http://{host}/{i}"))
        if rng.random() < 0.6:
            outcomes.append((i, rng.random() < share[host]))
    outcomes += [(0, True), (0, False), (None, True), (1, None), (99999, True)]
    got = {
        r["host"]: r
        for r in url_filter.judge(pages_of(spark, rows), outcomes_of(spark, outcomes), rules_of(spark, RULES[:1])).collect()
    }
    bad = {}
    for i, b in outcomes:
        if i is not None and b is not None:
            bad[i] = bad.get(i, False) or b
    host_n, host_x = Counter(), Counter()
    for i, url in rows:
        host = url[7:].split("/")[0]
        host_n[host] += i in bad
        host_x[host] += bad.get(i, False)
    levels = {}
    for host in host_n:
        name = host.split("@")[-1].split(":")[0]
        labels = name.split(".")
        width = 2 if name.endswith(".co.uk") else 1
        whole = len(labels) <= width or name == "10.0.0.1"
        levels[host] = (name, name) if whole else (".".join(labels[-width - 1 :]), ".".join(labels[-width:]))
    sums = lambda key: {
        k: (sum(host_n[h] for h in host_n if key(h) == k), sum(host_x[h] for h in host_n if key(h) == k))
        for k in {key(h) for h in host_n}
    }
    root = (sum(host_x.values()) + 1) / (sum(host_n.values()) + 2)
    suffix, _ = shrink({k: (n, x, root) for k, (n, x) in sums(lambda h: levels[h][1]).items()})
    suffix_of = {levels[h][0]: levels[h][1] for h in host_n}
    domain, _ = shrink({k: (n, x, suffix[suffix_of[k]]) for k, (n, x) in sums(lambda h: levels[h][0]).items()})
    mean, k = shrink({h: (host_n[h], host_x[h], domain[levels[h][0]]) for h in host_n})
    assert set(got) == set(host_n)
    for h, m in mean.items():
        least = max(0.0, m - 1.645 * math.sqrt(m * (1 - m) / (host_n[h] + k + 1)))
        assert got[h]["bad_mean"] == pytest.approx(m) and got[h]["bad_least"] == pytest.approx(least)
        assert got[h]["verdict"] == ("block" if least > 0.5 else "allow")
    assert {r["verdict"] for r in got.values()} == {"allow", "block"}


def test_frequent_hosts_are_not_shuffled_by_name(spark):
    rows = [(i, "http://hot.org/") for i in range(500)] + [(i, f"http://h{i}.org/") for i in range(500, 600)]
    judged = url_filter.judge(pages_of(spark, rows), outcomes_of(spark, [(1, True)]), rules_of(spark))
    assert judged.count() == 600
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_pages(spark):
    assert url_filter.judge(pages_of(spark, []), outcomes_of(spark, [(1, True)]), rules_of(spark)).count() == 0


# Resampling


def features(text, grams=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def brute_resample(docs, target, percent, least, buckets=10_000, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for i, text in docs:
        n_words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted(
        (r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0)
    )
    drawn = len(order) * percent // 100
    ranks = {id(r): k for k, r in enumerate(order[:drawn], 1)}
    return [(*r, ranks.get(id(r))) for r in rows]


def without_ties(rows):
    """Ranks among rows of one id and score are exchangeable: as sorted lists."""
    groups = defaultdict(list)
    for i, *rest, rank in rows:
        groups[i, *rest[-1:]].append((tuple(rest[:-1]), rank))
    return {
        k: (sorted(x for x, _ in v), sorted(rank for _, rank in v if rank is not None)) for k, v in groups.items()
    }


@pytest.mark.parametrize("percent", (0, 25, 60, 100))
def test_resampling_matches_brute_force(spark, odd_docs, odd_rows, percent, monkeypatch):
    monkeypatch.setattr(resampling, "PROBES", 3)
    rng = random.Random(8)
    more = [(rng.randrange(10**12) - 10**11, " ".join(rng.choices("ab cd EF gh ij 12 é字 k".split(), k=rng.randint(15, 40))), None) for _ in range(150)]
    more += [(77, "ab cd ef " * 10, None)] * 40 + [(None, "gh ij " * 12, None)] * 30
    rows = odd_rows + more
    target = ["ab cd ab cd EF", "字 é", None, "", "gh " * 40]
    table = spark.createDataFrame([(t, "x") for t in target], "text string, bucket string")
    got = resampling.resample(build(spark, rows).repartition(5), table, percent, least_words=20)
    want = brute_resample([(i, t) for i, t, _ in rows], target, percent, 20)
    assert without_ties(map(tuple, got.collect())) == without_ties(want)


def test_threshold_counts(spark):
    values = [-(2**63), -5, -5, 0, 0, 0, 9, 2**63 - 1]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for need in range(1, len(values) + 1):
        value, below, upto = resampling.threshold(rows, F.col("v"), need)
        assert value == values[need - 1]
        assert (below, upto) == (values.index(value), values.index(value) + values.count(value))


def test_joined_checksums():
    rng = random.Random(1)
    pairs = [(rng.randbytes(rng.randint(0, 9)), rng.randbytes(rng.choice((0, 1, 5, 31, 70_000)))) for _ in range(50)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    a, b = zip(*pairs)
    got = resampling.joined_crc(crc(a), crc(b), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


def test_longer_runs(spark):
    found, first = resampling.feature_buckets(pa.array(["a b c d", None, "x", "e f g"]), 3, 2**31)
    assert first.tolist() == [0, 4, 4, 5, 8]
    runs = [["a", "b", "c", "d", "x", "e", "f", "g"], ["a b", "b c", "c d", "e f", "f g"], ["a b c", "b c d", "e f g"]]
    assert [x.tolist() for _, x in found] == [[zlib.crc32(r.encode()) % 2**31 for r in rs] for rs in runs]


def test_resampling_of_nothing(spark, no_docs):
    empty = spark.createDataFrame([], "text string")
    assert resampling.resample(no_docs, empty).count() == 0
    one = resampling.resample(build(spark, [(1, "a " * 30, None)]), empty, 100).collect()
    assert [r["rank"] for r in one] == [1]


# Alignment

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(text):
    """Ids and bytes of both tokenizers, straight from the libraries."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B_FILE)
    symbols = alignment._byte_of_symbol()
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text, num_threads=1)
    a_bytes = [bytes(symbols[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    return a_ids, a_bytes, b_ids, b_bytes


def brute_align(docs):
    told, holding = [], Counter()
    for i, text in docs:
        groups, pairs, sizes = [], [], (0, 0)
        if text:
            a_ids, a_bytes, b_ids, b_bytes = plain_tokens(text)
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                sizes = (len(a_ids), len(b_ids))
                a_ends, b_ends = np.cumsum([*map(len, a_bytes)]), np.cumsum([*map(len, b_bytes)])
                x = y = 0
                for end in sorted(set(a_ends.tolist()) & set(b_ends.tolist())):
                    p, q = a_ends.tolist().index(end) + 1, b_ends.tolist().index(end) + 1
                    groups.append((a_ids[x:p], b_ids[y:q]))
                    x, y = p, q
                pairs = [(u, v) for us, vs in groups for u in us for v in vs]
        holding.update(set(pairs))
        told.append((i, sizes, groups, pairs))
    best = defaultdict(int)
    for (u, _), n in holding.items():
        best[u] = max(best[u], n)
    out = []
    for i, sizes, groups, pairs in told:
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (i, *sizes, len(groups), len(pairs), sum(holding[p] == best[p[0]] for p in pairs),
             sum(holding[p] for p in pairs), hashlib.sha256(shown.encode()).hexdigest() if groups else "")
        )
    return out


@pytest.mark.parametrize("large", (4, 4096))
def test_alignment_matches_brute_force(spark, odd_rows, monkeypatch, large):
    for name, value in (("BLOCK_BYTES", 900), ("STEP_BYTES", 300), ("LINKS_AT_ONCE", 50), ("LARGE_GROUP", large)):
        monkeypatch.setattr(alignment, name, value)
    rng = random.Random(3)
    rows = [(i, t[:3000] if t else t, lang) for i, t, lang in odd_rows]
    odd = ["a▁b", "▁", " ", "  x  ", "<s> </s> <unk> <|endoftext|>", "\x00\x01", "naïve café", "漢字とかな", "=" * 200,
           "🙂🙂 a🙂", "1234567 3.14", "tab\tline\r\n\n", "don't we'll", "\u3000wide", "e\u0301", "\u2028"]
    rows += [(100 + i, t, None) for i, t in enumerate(odd)]
    rows += [(200 + i, "".join(rng.choices("ab =-_<>|é1\n漢", k=rng.randint(1, 80))), None) for i in range(60)]
    got = alignment.align(build(spark, rows).repartition(4), A_FILE, B_FILE)
    assert Counter(map(tuple, got.collect())) == Counter(brute_align([(i, t) for i, t, _ in rows]))


def test_galloping_matches_sets():
    rng = np.random.default_rng(2)
    for _ in range(60):
        firsts, lists = ([0], [0]), ([], [])
        for doc in range(5):
            for first, ends, n in zip(firsts, lists, rng.integers(0, (1, 40, 3, 200)[doc % 4], 2)):
                ends += sorted((doc * 1000 + rng.choice(500, n, replace=False)).tolist())
                first.append(len(ends))
        a, b = np.array(lists[0], np.int64), np.array(lists[1], np.int64)
        at_a, at_b = alignment.common_ends(a, np.array(firsts[0]), b, np.array(firsts[1]))
        both = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[at_a].tolist() == b[at_b].tolist() == both


def test_long_misaligned_groups_stay_small():
    """Groups of many equal tokens are merged before their links are formed."""
    block = alignment._Aligned.__new__(alignment._Aligned)
    block.a, block.b = np.zeros(200_000, np.int64), np.ones(100_000, np.int64)
    block.group_a, block.group_b = block.end_a, block.end_b = np.array([200_000]), np.array([100_000])
    block.n_groups = np.array([1])
    doc, pair, times = block.links()
    assert (doc.tolist(), pair.tolist(), times.tolist()) == ([0], [1], [200_000 * 100_000])


def test_alignment_of_nothing(spark, no_docs):
    assert alignment.align(no_docs, A_FILE, B_FILE).count() == 0
    got = alignment.align(build(spark, [(None, None, None)]), A_FILE, B_FILE).collect()
    assert [tuple(r) for r in got] == [(None, 0, 0, 0, 0, 0, 0, "")]
