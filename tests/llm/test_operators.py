"""The training-data operators against brute-force versions and on edge cases."""

import base64
import gzip
import hashlib
import random
import re
import time
import zlib
from collections import Counter
from math import comb
from pathlib import Path
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lumenql.llm import bpe, common, decontam, gray, near_dup, oracles, pretoken, quality, queries, secret_scan, sharding, simhash, simple8b, token_file, toxicity, url_reputation, warc
from lumenql.llm import components as graph
from lumenql.llm.common import materialize
from lumenql.llm.components import connected_components
from tests.oracle_check import compare

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000
EDGE = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, LONG, "en", "s", 1), (4, LONG, "en", "s", 1), (4, LONG, "en", "s", 1), (None, "some text", "en", None, 2), (7, " \t\n ", "xx", "s", 3), (8, "É\u0000 <|endoftext|> ﬁ", "en", "s", 4)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOC).withColumn("hi", F.lit("clash")).withColumn("kept", F.lit(1)).withColumn("secret_spans", F.lit(2)).withColumn("__text", F.lit(3))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_oracle(spark, sf_dir, name):
    assert compare(spark, sf_dir, name, queries.QUERIES[name], oracles.ORACLES[name]).startswith("equal")


# -- near-duplicates


def components(links, n):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("block", [3, 1 << 17])
def test_gray_index(monkeypatch, block):
    monkeypatch.setattr(gray, "BLOCK", block)
    rng = np.random.default_rng(block)
    for _ in range(40):
        n = int(rng.integers(1, 90))
        values = rng.integers(0, 2**64, 5, dtype=np.uint64)[rng.integers(0, 5, n)]
        for _ in range(int(rng.integers(0, 6))):
            values = values ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        run = rng.integers(0, 3, n)
        order = np.lexsort((gray.gray_rank(values), run))
        values, run = values[order], run[order]
        links = [(i, j) for i in range(n) for j in range(i) if run[i] == run[j] and int(values[i] ^ values[j]).bit_count() <= 3]
        assert gray.link(values, run, 3).tolist() == components(links, n)


def check_components(docs, rows, **options):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs, **options).collect()}
    ids = sorted(rows)
    prints = [brute_fingerprint(rows[i]) for i in ids]
    links = [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    label = components(links, len(ids))
    assert got == {i: (f"{prints[k]:016x}", ids[label[k]]) for k, i in enumerate(ids)}


def test_simhash_components(docs, texts):
    check_components(docs, texts)


def test_simhash_hot_buckets(spark):
    """Buckets far above the limit are dealt in tiles and lose no link."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = {}
    for k in range(120):
        words = list(base)
        words[rng.randrange(400)] = f"x{k}"
        rows[k] = " ".join(words)
    check_components(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), rows, bucket_rows=6)


def brute_classes(rows, similarity=0.8):
    """Smallest row number of each near-duplicate class, by comparing every pair."""
    sets = []
    for text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} or {tuple(words)})
    links = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9]
    return components(links, len(sets))


def varied(rng, n, words, edits, name):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for j in range(rng.randrange(edits)):
            own[rng.randrange(words)] = f"{name}{k}x{j}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicate_classes(spark, monkeypatch, small):
    """All links at a Jaccard of 0.8, in one chunk and where keys and candidates are dealt into many."""
    if small:
        monkeypatch.setattr(near_dup, "CHUNK_TEXTS", 6)
    rng = random.Random(9)
    rows = varied(rng, 60, 150, 4, "a") + varied(rng, 40, 80, 5, "b") + varied(rng, 50, 30, 3, "c") + [" ".join(f"u{rng.randrange(900)}" for _ in range(60)) for _ in range(30)]
    rows += rows[:20] + ["One two", "one  TWO", "", None, "one"]
    rng.shuffle(rows)
    got = {r.doc_id: r["class"] for r in near_dup.near_duplicate_classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), bucket_rows=5 if small else near_dup.BUCKET_ROWS).collect()}
    first = {}
    for k in range(len(rows)):
        first.setdefault(got[k], k)
    want = brute_classes(rows)
    smallest = {}
    for k in range(len(rows)):
        smallest.setdefault(want[k], k)
    assert [first[got[k]] for k in range(len(rows))] == [smallest[want[k]] for k in range(len(rows))]
    assert len(set(want)) < len(rows) - 60


def test_small_tables_are_written_to_few_files(spark, monkeypatch):
    """However many partitions a shuffle has: each file costs an executor a commit and, on a local file system, a process."""
    rng, files = random.Random(6), []

    def counted(df, name):
        out, path = materialize(df, name)
        files.append((name, len(out.inputFiles())))
        return out, path

    for module in (graph, near_dup, simhash):
        monkeypatch.setattr(module, "materialize", counted)
    monkeypatch.setattr(near_dup, "CHUNK_TEXTS", 8)
    rows = varied(rng, 80, 120, 4, "a") + [" ".join(f"v{rng.randrange(9999)}" for _ in range(30)) for _ in range(200)]
    settings = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = near_dup.drop_near_copies(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), bucket_rows=8)
        assert kept.count() == len(set(brute_classes(rows)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {n for n, _ in files} >= {"links", "large-star", "routed", "met", "set-links", "stays"}
    assert max(n for _, n in files) <= 4 * spark.sparkContext.defaultParallelism


def test_set_links_equal_brute_force():
    rng = random.Random(10)
    for _ in range(60):
        sets = [np.unique(np.array([rng.randrange(30) for _ in range(rng.randrange(1, 14))], np.uint64)) for _ in range(rng.randrange(2, 14))]
        links = [(a, b) for a in range(len(sets)) for b in range(a) if len(x := set(sets[a].tolist()) & set(sets[b].tolist())) >= 0.8 * (len(sets[a]) + len(sets[b]) - len(x)) - 1e-9]
        got = near_dup.link_sets(sets, np.arange(len(sets)), 0.8).tolist()
        want = components(links, len(sets))
        assert len(set(zip(got, want))) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("drop", [simhash.drop_near_duplicates, near_dup.drop_near_copies])
def test_dropping_copies_tells_rows_by_id_and_text(spark, edge, none, drop):
    a, b = "one text of several words in a row here", "an altogether different document with other words inside"
    rows = [(1, a), (5, a), (5, b), (7, b), (1, a), (None, a), (None, None), (None, "a third text without any id that nobody else has got")]
    got = drop(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class int"))
    assert got.columns == ["doc_id", "text", "class"]
    assert sorted(((r.doc_id or 0), r.text or "") for r in got.collect()) == sorted([(1, a), (5, b), (0, ""), (0, rows[-1][1])])
    kept = drop(edge)
    assert kept.columns == edge.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 8]
    assert drop(none).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (None, 3)]
    found, _ = connected_components(spark.createDataFrame(edges, "a long, b long"))
    got = dict(tuple(r) for r in found.collect())
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 60)}


def test_simhash_edges(edge, none):
    got = simhash.simhash_components(edge).collect()
    assert len(got) == len(EDGE)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == "0" * 16 and {by_id[k].component_id for k in (1, 2, 7)} == {1}
    assert by_id[4].component_id == 3 and by_id[None].component_id is None
    assert simhash.simhash_components(none).count() == 0


# -- secrets


def test_secret_spans_find_random_strings(spark):
    rows = [(1, 'key = "kJ8s2Lq9ZxW4vB7nM1cT6yR3" end'), (2, "id 3f2504e0-4f89-41d3-9a0c-0305e82c3301 x"), (3, "thequickbrownfoxjumpsoverthelazydog1"), (4, "exampleKJ8s2Lq9ZxW4vB7nM1cT6yR3"), (5, "AAAAAAAAAAAAAAAAAAAAAAAAa1"), (6, "3F9A1B7C5D2E8F406172A3B4C5D6E7F8")]
    got = {r.doc_id: r.s for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", secret_scan.as_text(F.col("secret_spans")).alias("s")).collect()}
    assert got == {1: "entropy:7:31", 2: "", 3: "", 4: "", 5: "", 6: got[6]} and got[6].startswith("entropy:0:")


def test_secret_base_semantics(spark):
    rows = [(1, "token=secret:abcdefghijklmnop"), (2, "é PASSWORD = 'abcdefghijkl' AKIAABCDEFGHIJKLMN"), (3, "passwd:short"), (4, "0123456789abcdef" * 2)]
    got = {r.doc_id: r.s for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", secret_scan.as_text(F.col("secret_spans")).alias("s")).collect()}
    assert got == {1: "", 2: "assign:2:26,access:28:46", 3: "", 4: "hex:0:32"}


def test_entropy_counts(spark):
    """The incremental window agrees with entropies computed anew for each window."""
    rng, rules = random.Random(3), secret_scan.Rules()
    rows = [(k, "".join(rng.choice("aB3" if k % 3 == 0 else "abcdefGHIJK1234567890") for _ in range(rng.randrange(20, 70)))) for k in range(60)]
    got = {r.doc_id: [tuple(s) for s in r.secret_spans if s.kind == 3] for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    terms = rules.terms()
    for k, text in rows:
        sums = [sum(terms[c] for c in Counter(text[i : i + 20]).values()) for i in range(len(text) - 19)]
        mixed = re.search("[a-z]", text) and re.search("[A-Z]", text)
        alone = re.search(secret_scan.SINGLE_CASE, text) and re.search(secret_scan.TWO_RUNS, text) and 16 * sum(c.isdigit() for c in text) >= len(text)
        bits = rules.hex_bits if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text) else rules.alnum_bits if mixed else rules.single_bits
        hot = [i for i, s in enumerate(sums) if s <= rules.most(bits)]
        skip = not (mixed or alone) or not re.search("[0-9]", text) or any(re.search(p, text) for p in rules.allowed) or re.fullmatch("[0-9a-f]{16,}", text)
        assert got[k] == ([] if skip or not hot else [(hot[0], 3, hot[-1] + 20)]), (k, text)


def test_secrets_around_a_base_span_go_whole(spark):
    secret = "Zq7Lk2Pd9XsB9f3a1c7e5b2d8064af0Wm3Yt8RvN5Hc1"
    rows = [(1, f"see {secret} here"), (2, "key k3j9x2m7q8w4z6t1v5b0n3c8 end"), (3, "K3J9X2M7Q8W4Z6T1V5B0N3C8"), (4, "token = " + secret)]
    got = secret_scan.redact(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["see <secret> here", "key <secret> end", "<secret>", "<secret>"]


def test_pipeline_masks_random_strings_of_one_case(spark, sf_dir):
    import corpus_pipeline

    rng = random.Random(5)
    kinds = [("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 52), ("abcdefghijklmnopqrstuvwxyz234567", 52), ("abcdefghijklmnopqrstuvwxyz0123456789", 40), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 32)]
    secrets = ["".join(rng.choices(a, k=n)) for a, n in kinds for _ in range(25)] + ["Q7RT2-M9XKP-4WZ8C-H3VNB-6JDL5", "JBSWY3DPEHPK3PXPK5TQ2M4N7RZ6Y3LW===="]
    plain = ["thequickbrownfoxjumpsoverthelazydog1", "internationalization2024", "3f2504e0-4f89-41d3-9a0c-0305e82c3301", "z1z1z1z1z1z1z1z1z1z1z1z1", "chapter-12/section-03/page-0045"]
    docs = spark.createDataFrame([(k, f"see {t} here", "en", "s", 1) for k, t in enumerate(secrets + plain)], DOC)
    got = {r.doc_id: r.text for r in corpus_pipeline.secrets_stage(spark, docs, sf_dir).collect()}
    missed = [t for k, t in enumerate(secrets) if "<secret>" not in got[k] or len(got[k]) > 30]
    assert not missed
    assert all(got[len(secrets) + k] == f"see {t} here" for k, t in enumerate(plain))


def test_secret_edges(edge, none):
    got = secret_scan.scan_secrets(edge, out="found")
    assert {len(r.found) for r in got.collect()} == {0} and got.count() == len(EDGE)
    assert secret_scan.scan_secrets(none).count() == 0
    masked = secret_scan.redact(edge)
    assert masked.columns == edge.columns and sorted(map(str, masked.collect())) == sorted(map(str, edge.collect()))


def test_redaction(spark):
    rows = [(1, 'a token="0123456789abcdef0123" b 0123456789abcdef c'), (2, None)]
    got = secret_scan.redact(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.text for r in got] == ['a <secret>" b <secret> c', None]


# -- shards


def test_shards(spark, docs, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "s"), base_bytes=1 << 12, target_bytes=1 << 17)
    store.append_batches(docs.withColumn("arrival", F.col("doc_id") % 6), "arrival")
    assert store.version() == 6 and len(store.manifest()) == 6
    old = store.manifest(3)
    assert store.compact() >= 1 and len(store.manifest()) < 6
    assert store.read().drop("shard", "arrival").exceptAll(docs).isEmpty() and store.read().count() == docs.count()
    assert store.read(3).count() == docs.where("doc_id % 6 < 3").count() and old == store.manifest(3)
    with pytest.raises(sharding.CommitConflict):
        store.commit(0, [])
    store.vacuum()
    assert store.read().count() == docs.count()


def test_shard_edges(edge, none, spark, tmp_path):
    clash = edge.withColumn("arrival", F.col("doc_id") % 2).withColumn("shard", F.lit("own")).withColumn("__batch", F.lit(5))
    store = sharding.shard_table(clash, "arrival", str(tmp_path / "e"))
    got = store.read(shard="file")
    assert got.drop("file").columns == clash.columns and got.drop("file").exceptAll(clash).isEmpty() and got.count() == len(EDGE)
    with pytest.raises(ValueError, match="shard"):
        store.read()
    empty = sharding.shard_table(none.withColumn("arrival", F.lit(0)), "arrival", str(tmp_path / "n"))
    assert empty.version() == 1 and empty.read().count() == 0 and empty.read().columns == [*none.columns, "arrival", "shard"]
    with pytest.raises(ValueError, match="no version"):
        sharding.ShardStore(spark, str(tmp_path / "new")).read()


def test_shard_writers_conflict(spark, docs, tmp_path):
    """An append that loses a race is committed on the winner's version; files of the loser are not orphaned."""
    one, two = (sharding.ShardStore(spark, str(tmp_path / "s")) for _ in range(2))
    one.append(docs.where("doc_id < 50"))
    honest = two.version
    stale = iter([1])
    one.append(docs.where("doc_id between 50 and 99"))
    two.version = lambda: next(stale, None) or honest()
    assert two.append(docs.where("doc_id >= 100")) == 3
    assert one.read().count() == docs.count() and len(one.manifest()) == 3
    with pytest.raises(ValueError, match="columns"):
        one.append(docs.select("doc_id"))


# -- urls


def test_url_parts(spark):
    urls = [None, "no scheme", "http://A.B.com", "x://h:80/p/q?r#s", "a://b?c/d", "ftp://u@H/\u00c9#x"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(url_reputation.host_of(F.col("u")), url_reputation.path_of(F.col("u"))).collect()]
    assert got == [("", ""), ("", ""), ("a.b.com", ""), ("h:80", "/p/q"), ("b", ""), ("u@h", "/\u00c9")]


def test_reputation_blocks_bad_hosts_only_with_evidence(spark):
    outcomes = [(f"bad.spam.com", 0)] * 60 + [("good.fine.com", 1)] * 60 + [("new.fine.com", 0)] + [("other.org", 1)] * 40
    pages = [(1, "http://bad.spam.com/x"), (2, "http://good.fine.com/"), (3, "http://new.fine.com/"), (4, None), (5, "http://unseen.net/"), (6, "http://sub.spam.com/")]
    judged = url_reputation.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "host string, good int"), queries.URL_RULES, prior=url_reputation.Prior(least=0.5))
    assert {r.page_id: r.verdict for r in judged.collect()} == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "block"}  # 6 follows its domain
    empty = spark.createDataFrame([], "host string, good int")
    judged = url_reputation.judge_urls(spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit(1)), empty, queries.URL_RULES)
    assert judged.count() == 6 and {r.verdict for r in judged.collect()} == {"allow"}


@pytest.mark.parametrize(("a", "b"), [(2.0, 3.0), (0.3, 0.4), (150.0, 60.0), (20.0, 900.0), (4000.0, 1400.0), (1.0, 1.0)])
def test_beta_distribution(spark, a, b):
    """The continued fraction against a sum over a fine grid of the rate's angle."""
    from math import lgamma

    phi = (np.arange(400_000) + 0.5) / 400_000 * np.pi / 2
    dense = np.exp((2 * a - 1) * np.log(np.sin(phi)) + (2 * b - 1) * np.log(np.cos(phi)) - (lgamma(a) + lgamma(b) - lgamma(a + b)))
    for least in (0.02, 0.5, 0.75):
        want = (dense * (np.sin(phi) ** 2 < least)).sum() * 2 * (np.pi / 2 / len(phi))
        got = spark.range(1).select(url_reputation.below(least, F.lit(a), F.lit(b))).first()[0]
        assert got == pytest.approx(want, abs=2e-3 if min(a, b) < 1 else 1e-4)


def test_url_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (2, ""), (None, None), (3, "http://a.com/" + "y" * 200_000)], "page_id long, url string").withColumn("bad", F.lit("clash")).withColumn("rule", F.lit(1))
    outcomes = spark.createDataFrame([("a.com", 0)] * 50 + [("b.org", 1)] * 50 + [(None, 1), ("a.com", None), ("", 0)], "host string, good int")
    rules = [url_reputation.rule("allow", "a.com/x"), url_reputation.rule("block", "a.com/x")]
    judged = url_reputation.judge_urls(pages, outcomes, rules).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in judged) == [(0, None, "allow"), (1, "a.com/x", "block"), (1, "a.com/x", "block"), (2, None, "allow"), (3, None, "block")]
    assert url_reputation.judge_urls(pages.where("false"), outcomes, rules).count() == 0


# -- archives


def test_chunks_and_segments():
    data = ("é€ab\r\n0\r\n\r\n" * 5000).encode()
    assert warc.unframe(warc.frame(data)) == data and warc.unframe(warc.frame(b"")) == b""
    parts = list(warc.records(1, "http://x/\r\ny", data, hashlib.sha1(data).hexdigest(), None, "n", 1000))
    back = list(warc.parse(b"".join(parts)))
    assert len(back) > 3 and "warc-segment-total-length" in back[-1][0] and back[1][0]["warc-segment-origin-id"] == back[0][0]["warc-record-id"]
    segments = [(int(f["warc-segment-number"]), int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, b) for f, b in back]
    random.Random(1).shuffle(segments)
    assert warc.unframe(warc.reassemble([*segments, segments[0]]).split(b"\r\n\r\n", 1)[1]) == data
    with pytest.raises(ValueError, match="gap"):
        warc.reassemble(segments[1:] if segments[0][0] != len(segments) else segments[:-1])
    with pytest.raises(ValueError):
        warc.unframe(warc.frame(data)[:-9])


def test_warc_round_trip(spark, tmp_path):
    long = "ab\r\n\r\né\0" * 40_000
    rows = [(1, "http://a", "x" * 1500), (2, "http://b", "x" * 1500), (3, None, None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "u", long), (7, "u", long), (None, "u", "x" * 1500), (8, "u", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    back = warc.round_trip(pages, str(tmp_path / "w"), segment_bytes=4096).collect()
    got = {r.page_id: r for r in back}
    assert len(back) == len(rows)
    assert {k: (r.record_type, r.refers_to) for k, r in got.items() if r.record_type == "revisit"} == {1: ("revisit", 2), None: ("revisit", 2)}
    for key, _, html in rows:
        data = (html or "").encode()
        assert (got[key].payload_bytes, got[key].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert got[key].record_type == "revisit" or got[key].payload == data
    assert warc.round_trip(pages.where("false"), str(tmp_path / "none")).count() == 0
    # Each record is a gzip member, and members fill the files.
    for file in (tmp_path / "w").glob("*.txt"):
        raw, members = file.read_bytes(), 0
        while raw:
            d = zlib.decompressobj(31)
            assert d.decompress(raw).startswith(b"WARC/1.1\r\n") and d.eof
            raw, members = d.unused_data, members + 1
        assert members
    assert warc.read_records(spark, str(tmp_path / "w")).where("record_type = 'continuation'").count() > 100


def test_only_repeated_payloads_move(spark, tmp_path):
    """Rows whose payload stands once are told by a bitmap, so that their texts are not shuffled."""
    rows = [(k, f"http://{k}", f"{k % 2000:04} " * 400) for k in range(2040)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    digests = pages.select("page_id", F.sha1("html").alias("digest"))
    copies = digests.groupBy(F.col("digest").alias("of")).count().where("count > 1")
    met = {r.page_id for r in warc.repeated(digests, copies).where("met").collect()}
    assert met >= {*range(40), *range(2000, 2040)} and len(met) < 90
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = {r.page_id: (r.record_type, r.refers_to, r.payload_digest) for r in warc.round_trip(pages, str(tmp_path / "w")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {k: (*(("revisit", k + 2000) if k < 40 else ("response", None)), hashlib.sha1(html.encode()).hexdigest()) for k, _, html in rows}


def test_archives_are_few_files(spark, tmp_path, sf_dir):
    """Files are cut by bytes, not by a number of records that suits the longest ones, and what is read back is written nowhere else."""
    pages = spark.range(3000).coalesce(1).select(F.col("id").alias("page_id"), F.lit("http://x").alias("url"), F.repeat(F.format_string("%04d ", "id"), 300).alias("html"))
    before = {str(p) for p in Path(common.shared_dir(spark).removeprefix("file:")).rglob("part-*")}
    back = warc.round_trip(pages, str(tmp_path / "w"), segment_bytes=8192)
    assert back.agg(F.count("*"), F.sum("payload_bytes"), F.countDistinct("payload_digest")).first() == (3000, 3000 * 1500, 3000)
    assert len(list((tmp_path / "w").glob("part-*.txt"))) == 1
    kept = {str(p) for p in Path(common.shared_dir(spark).removeprefix("file:")).rglob("part-*")} - before
    assert kept and not [p for p in kept if "warc-copies" not in p]
    # The widest segments still make files of less than 64 MB.
    assert warc.FILE_BYTES // (warc.SEGMENT_BYTES + warc.HEAD_BYTES) <= 1024
    cores = spark.sparkContext.defaultParallelism
    assert queries.op5_warc(spark, sf_dir).rdd.getNumPartitions() <= cores


def test_foreign_archive(spark, tmp_path):
    """Loose header lines, other record types, base-32 digests, shuffled segments, one gzip member or none."""
    page = b"<p>h\xe9llo</p>"
    body = b"5;x=1\r\n<p>h\xe9\r\n7\r\nllo</p>\r\n0\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nContent-Type:text/html\r\nTransfer-Encoding:chunked\r\nbad line\r\n\r\n" + body
    digest = base64.b32encode(hashlib.sha1(page).digest()).decode()
    cut = len(http) // 2
    make = lambda block, *lines: ("WARC/1.0\r\n" + "".join(f"{x}\r\n" for x in (*lines, f"content-length:{len(block)}")) + "\r\n").encode() + block + b"\r\n\r\n"
    records = [
        make(b"software: x\r\n", "WARC-Type: warcinfo", "WARC-Record-ID: <a>"),
        make(http[cut:], "WARC-Type: continuation", "WARC-Record-ID: <c>", "WARC-Segment-Origin-ID: <b>", "WARC-Segment-Number: 2", f"WARC-Segment-Total-Length: {len(http)}"),
        make(b"GET / HTTP/1.1\r\n\r\n", "WARC-Type:request", "WARC-Record-ID: <d>"),
        make(http[:cut], "WARC-Type: response", "WARC-Record-ID: <b>", "WARC-Target-URI: http://x/", f"WARC-Payload-Digest: sha1:{digest}", "WARC-Segment-Number: 1"),
        make(b"HTTP/1.1 304 Not Modified\r\n\r\n", "WARC-Type: revisit", "WARC-Record-ID: <e>", "WARC-Target-URI: http://y/", "WARC-Payload-Digest:", "  sha1:" + digest),
        make(b"plain", "WARC-Type: resource", "WARC-Record-ID: <f>", "WARC-Target-URI: http://z/"),
    ]
    for name, data in (("one.warc.gz", gzip.compress(b"".join(records))), ("many.warc.gz", b"".join(map(gzip.compress, records))), ("raw.warc", b"".join(records))):
        (tmp_path / name).write_bytes(data)
        got = {r.url: r for r in warc.read_warc(spark, str(tmp_path / name)).collect()}
        assert set(got) == {"http://x/", "http://y/", "http://z/"}
        assert bytes(got["http://x/"].payload) == page and got["http://x/"].page_id is None
        assert got["http://y/"].record_type == "revisit" and got["http://y/"].payload_digest == digest and got["http://z/"].payload_bytes == 5
    assert warc.read_records(spark, str(tmp_path)).count() == 18


# -- encodings


POOL = ["a", "B", "é", "É", "ß", "İ", "Σ", "ς", "'s", "'LL", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "1", "²", "½", "٣", "中", "😀", "é", "ｱ", "_", "-", "!!", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "​", "ﬁ", "x" * 300, "ǆ", "ª", "\x00", "\x7f", "ab" * 100, "Ⅷ", "K", "ſ"]


def test_encoders_equal_the_library(tokenizer, texts):
    rng = random.Random(1)
    cases = ["".join(rng.choice(POOL) for _ in range(rng.randrange(12))) for _ in range(400)] + list(texts.values())[:120]
    own, packed = bpe.load(queries.tokenizer_path()), token_file.LibraryEncoder(queries.tokenizer_path())
    for text in cases:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids and np.frombuffer(packed.encode(text), np.uint32).tolist() == ids, repr(text)
        assert own.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)


def test_token_encoder_looks_words_up_in_groups(tokenizer, texts, monkeypatch):
    """Tables that are trimmed, groups that end anywhere and texts that the library cuts change no id."""
    monkeypatch.setattr(token_file, "WORDS", 60)
    monkeypatch.setattr(token_file, "KNOWN", 20)
    monkeypatch.setattr(token_file, "GROUP_CHARS", 300)
    rng = random.Random(2)
    pool = [" ", " ", "\n", "\t\r ", "the", "The", "don't", "x1y22,", "(é)", "ab" * 300, "7" * 400, "中", "<|endoftext|>", "", "A\x85b"]
    cases = ["", "", *("".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(300)), *list(texts.values())[:60], "", "<|endoftext|>"]
    encoder = token_file.LibraryEncoder(queries.tokenizer_path())
    sizes = []
    got = [sizes.append(len(encoder.table.words)) or np.frombuffer(ids, np.uint32).tolist() for ids in encoder.encode_all(t or "" for t in cases)]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in cases]
    assert any(b < a for a, b in zip(sizes, sizes[1:])) and list(encoder.encode_all([])) == []


def test_token_encoder_costs_less_than_splitting():
    rng = np.random.default_rng(3)
    words = np.array(["".join(rng.choice(list("abcdefgh"), 6)) + "," * (k % 4 == 0) for k in range(2000)])
    text = " ".join(words[rng.integers(0, 2000, 400_000)].tolist())
    encoder = token_file.LibraryEncoder(queries.tokenizer_path())

    def seconds(use):
        began = time.process_time()
        use()
        return time.process_time() - began

    split = min(seconds(lambda: encoder.splitter.plain(text)) for _ in range(5))
    assert min(seconds(lambda: encoder.encode(text)) for _ in range(5)) < split


def test_plain_characters_split_as_in_the_library():
    splitter = pretoken.Splitter(queries.tokenizer_path())
    plain = [chr(p) for p in range(0x250) if pretoken.PLAIN.fullmatch(chr(p))]
    for text in [f"a{c}b {c}li{c} 1{c}" for c in plain] + ["Əli Bayramov", "Ɔkɔm", "ƁA ƊE"]:
        assert splitter._split(text) == splitter.exact(text), repr(text)


def test_forced_boundaries_are_certain():
    """No token of the vocabulary spans a cut, and cutting changes no result."""
    own = bpe.load(queries.tokenizer_path())
    letters = own.splitter.letters("straße")
    assert "".join(own.fragments(letters)) == letters
    cut = next(a + b for a in "zqx\u0101" for b in "ĢĤ" if a + b not in own.inside)
    assert not any(cut in t for t in own.vocab)


def test_cache_keeps_frequent_keys():
    made = Counter()

    def make(k):
        made[k] += 1
        return k

    cache = pretoken.Cache(make, 10)
    for k in range(1000):
        assert cache[k] == k and cache["often"] == "often"
        assert len(cache) <= 10
    assert made["often"] == 1


def test_encode_edges(edge, none, tokenizer):
    got = bpe.encode_decode(edge, queries.tokenizer_path()).collect()
    want = {(i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in EDGE}
    assert {(r.doc_id, tuple(r.ids)) for r in got} == want and len(got) == len(EDGE)
    assert bpe.encode_decode(none, queries.tokenizer_path()).count() == 0


def test_encoder_hands_rows_on_and_memory_back(texts, monkeypatch):
    class Rows:
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    back = []
    monkeypatch.setattr(bpe, "HELD_IDS", 1000)
    monkeypatch.setattr(common, "pa", SimpleNamespace(default_memory_pool=lambda: SimpleNamespace(release_unused=lambda: back.append(1))))
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()))], ["doc_id", "text"])
    out = list(bpe.encode_decode(Rows(), queries.tokenizer_path())(iter([batch])))
    assert [k for b in out for k in b.column(0).to_pylist()] == list(texts) and back == [1]
    encoder = bpe.load(queries.tokenizer_path())
    assert [ids for b in out for ids in b.column(2).to_pylist()] == [encoder.encode(t or "") for t in texts.values()]
    assert len(out) > 1 and all(sum(b.column(1).to_pylist()[:-1]) < 1000 for b in out)


def test_simple8b_round_trip():
    rng = np.random.default_rng(5)
    for k in range(60):
        ids = np.array([rng.integers(0, 2 ** int(w), dtype=np.uint64) for w in rng.integers(1, 64, rng.integers(0, 200))], dtype=np.uint64)
        ids = np.r_[np.zeros(300, np.uint64), ids, np.uint64(2**64 - 1)] if k % 2 else ids
        lengths = np.array([len(ids) // 2, 0, len(ids) - len(ids) // 2])
        words, first = simple8b.pack_rows(ids, lengths)
        assert (simple8b.unpack(words) == ids).all()
        assert (simple8b.unpack(words[int(first[2]) :]) == ids[lengths[0] :]).all()


def greedy(ids):
    """Selector and number of ids of each word, by trying every selector."""
    out = []
    while len(ids):
        fit = [s for s in range(1, 16) if simple8b.COUNT[s] <= len(ids) and all(int(i).bit_length() <= simple8b.WIDTH[s] for i in ids[: simple8b.COUNT[s]])]
        out.append(max(fit, key=lambda s: simple8b.COUNT[s], default=0))
        ids = ids[simple8b.COUNT[out[-1]] :]
    return out


def test_packing_is_greedy_and_costs_a_few_steps_an_id():
    rng = np.random.default_rng(7)
    for k in range(40):
        ids = rng.integers(0, 1 << int(rng.integers(1, 17)), int(rng.integers(0, 300)), dtype=np.uint64) * (rng.random() < rng.random(1))
        if k % 4 == 0:
            ids = np.r_[np.zeros(200, np.uint64), ids, np.array([1 << 63], np.uint64)]
        words = simple8b.pack(ids)
        heads = greedy(ids.tolist())
        assert len(words) == len(heads) + heads.count(0) and (simple8b.unpack(words) == ids).all()
    ids = rng.integers(0, 49_000, 1 << 18).astype(np.uint32)
    numbers, lengths = ids.tolist(), np.full(1 << 10, 1 << 8)

    def seconds(use):
        began = time.process_time()
        use()
        return time.process_time() - began

    step = min(seconds(lambda: [n + 1 for n in numbers]) for _ in range(7))
    assert min(seconds(lambda: simple8b.pack_rows(ids, lengths)) for _ in range(7)) < 2.8 * step


def test_token_files(spark, docs, edge, none, tokenizer, tmp_path):
    for n, table in enumerate((docs, edge)):
        rows = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in table.collect()]
        got = token_file.round_trip(table, queries.tokenizer_path(), str(tmp_path / f"t{n}"), digests=False, block_ids=500).collect()
        assert sorted(((r.doc_id or -1, list(r.ids)) for r in got)) == sorted((i or -1, t) for i, t in rows)
        got.sort(key=lambda r: r.start)
        assert [r.doc_id or -1 for r in got] == sorted(i or -1 for i, _ in rows)
        assert [r.start for r in got] == np.r_[0, np.cumsum([len(r.ids) for r in got])][:-1].tolist()
    crc = token_file.read_tokens(spark, str(tmp_path / "t0"), digests=True).orderBy("doc_id").first()
    want = np.array(tokenizer.encode(docs.where(f"doc_id = {crc.doc_id}").first().text, add_special_tokens=False).ids + [1], dtype="<u4")
    assert crc.ids_crc32 == zlib.crc32(want.tobytes()) and crc.n_tokens == len(want)
    assert token_file.round_trip(none, queries.tokenizer_path(), str(tmp_path / "n")).count() == 0


# -- toxicity


def test_toxicity_held_out(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.01")
    got = queries.op7_toxicity(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").where("held_out").collect()
    truth, score = np.array([r.toxic for r in got]), np.array([r.score for r in got])
    pairs = score[truth == 1][:, None] - score[truth == 0][None, :]
    assert ((pairs > 0) + 0.5 * (pairs == 0)).mean() > 0.85 and ((score >= 0) & (score <= 1)).all()


def test_kernel_tolerates_inserted_characters():
    rng = random.Random(2)
    plain = ["".join(rng.choice("etaoinshr") for _ in range(6)) for _ in range(200)]
    make = lambda bad: " ".join(rng.choice(plain) for _ in range(30)) + (f" {bad}. " if bad else ". ")
    texts = [make(rng.choice(["moron", "scumbag"])) for _ in range(80)] + [make("") for _ in range(160)]
    model = toxicity.fit(texts, [1] * 80 + [0] * 160)
    score = dict(zip(words := ["moron", "m.o.r.o.n", "mo-ron", "moxron", "scum.bag", *plain[:20]], model.words(words)))
    assert min(score[w] for w in words[:5]) > max(score[w] for w in plain[:20])
    assert toxicity.tokens("you m o r o n !") [-1] == "moron!" or "moron" in " ".join(toxicity.tokens("you m o r o n !"))


def test_kernel_features_equal_brute_force():
    word = "banana"
    codes = [toxicity.START, *[toxicity._symbol(c) for c in word], toxicity.STOP]
    want = Counter()
    for i in range(len(codes)):
        for j in range(i + 1, len(codes)):
            for k in range(j + 1, min(len(codes), i + toxicity.SPAN)):
                want[(codes[i] * toxicity.SYMBOLS + codes[j]) * toxicity.SYMBOLS + codes[k]] += toxicity.DECAY ** (k - i + 1)
    norm = sum(v * v for v in want.values()) ** 0.5
    _, code, value = toxicity.features([word])
    assert dict(zip(code.tolist(), value.round(9))) == {c: round(v / norm, 9) for c, v in want.items()}


def dense_kernel(a, b):
    """The gapped-subsequence kernel of two words by enumeration, each word of unit length."""

    def vector(word):
        codes = [toxicity.START, *[toxicity._symbol(c) for c in word], toxicity.STOP]
        out = Counter()
        for i in range(len(codes)):
            for j in range(i + 1, len(codes)):
                for k in range(j + 1, min(len(codes), i + toxicity.SPAN)):
                    if codes[i] and codes[j] and codes[k]:
                        out[codes[i], codes[j], codes[k]] += toxicity.DECAY ** (k - i + 1)
        norm = sum(v * v for v in out.values()) ** 0.5
        return {c: v / norm for c, v in out.items()}

    x, y = vector(a), vector(b)
    return sum(v * y.get(c, 0.0) for c, v in x.items())


def test_machine_equals_dense_kernel(monkeypatch):
    """With every word a landmark, the folded machine is the kernel machine that a dense kernel matrix gives."""
    rng = random.Random(6)
    plain = sorted({"".join(rng.choice("etaoinshr") for _ in range(5)) for _ in range(40)})
    texts = [" ".join(rng.choice(plain) for _ in range(12)) + (" moron scum" if k % 3 == 0 else "") for k in range(60)]
    y = np.array([int(k % 3 == 0) for k in range(60)])
    monkeypatch.setattr(toxicity, "LANDMARKS", 500)
    weight, bias = toxicity._fit_words(texts, y)
    words = sorted({w for t in texts for w in t.split()})
    kernel = np.array([[dense_kernel(a, b) for b in words] for a in words])
    count = [Counter(), Counter()]
    for t, label in zip(texts, y):
        count[label].update(set(t.split()))
    total = [1 + int((y == 0).sum()), 1 + int((y == 1).sum())]
    pos, neg = (np.array([count[label][w] / total[label] for w in words]) for label in (1, 0))
    cost, target = 2000.0 * np.r_[pos, 3 * neg + 0.5 / total[1]], np.r_[np.ones(len(words)), -np.ones(len(words))]
    # The same machine in its dual form: f = K a + b, squared hinge, ridge a' K a / 2.
    size, turn = np.linalg.eigh(kernel)
    root = turn[:, size > 1e-6] * np.sqrt(size[size > 1e-6])
    fit = toxicity._machine(np.r_[root, root], target, cost)
    want = root @ fit[:-1] + fit[-1]
    got = toxicity.Model(weight, bias, np.zeros(6)).words(words)
    assert got == pytest.approx(want, abs=1e-3)


def test_toxicity_edges(edge, none, spark):
    for labels in ([], [(1, 0)], [(1, 0), (3, 1), (4, None), (None, 1)]):
        model = toxicity.train(edge, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = toxicity.score(edge, model).collect()
        assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, model).count() == 0


# -- decontamination


ITEM = "Yesterday Tom bought 5 pears and Ann sold 5 pears for 20 dollars in Rome."


@pytest.mark.parametrize(("text", "found"), [
    (ITEM, True), (f"words before. {ITEM} And after, too.", True), (ITEM.upper(), True), (ITEM.lower(), True),
    ("Yesterday Sam bought 9 pears and Eve sold 9 pears for 31 dollars in Oslo.", True),
    ("Yesterday Sam bought 9 pears and Eve sold 8 pears for 31 dollars in Oslo.", False),
    ("Yesterday it rained and nobody bought pears for any money.", False), ("", False), (None, False),
])
def test_leaks(spark, text, found):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").withColumn("item_id", F.lit(9))
    got = decontam.find_leaks(docs, spark.createDataFrame([(3, ITEM), (4, None), (5, "two words")], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == ([(1, 3)] if found else [])


@pytest.mark.parametrize("text", [
    ITEM.replace("sold 5", "sold 6"),
    "Tom left. " + ITEM.replace("5 pears and", "6 pears and"),
    ITEM.replace("5 pears", "20 pears", 1),
])
def test_one_edited_slot_leaves_the_rest_of_a_copy(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = decontam.find_leaks(docs, spark.createDataFrame([(3, ITEM)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.n_changed_slots) for r in got] == [(1, 3, 0)]


def test_slots_that_meet_take_only_their_windows(spark):
    tail = "the gardener carried all of them down to the old market by the river"
    docs = spark.createDataFrame([(1, f"We had 4 pears and 4 plums and {tail}")], "doc_id long, text string")
    bench = spark.createDataFrame([(3, f"We had 3 pears and 5 plums and {tail}")], "item_id long, text string")
    assert decontam.find_leaks(docs, bench).count() == 1


@pytest.mark.parametrize(("item", "text", "found"), [
    ("What is 12*7?", "Quiz. what is 12*7? Easy.", True), ("What is 12*7?", "What is 12*8?", False), ("What is 12*7?", "What is 12", False),
    ("水的沸点是多少度", "问题:请问水的沸点是多少度呢", True), ("水的沸点是多少度", "今天天气很好我们去公园", False), ("沸点", "水的沸点", True),
    ("ประเทศไทยมีกี่จังหวัด", "ถามว่าประเทศไทยมีกี่จังหวัดครับ", True), ("東京はどこですか", "では東京はどこですかと聞く", True),
])
def test_short_items_and_scripts_without_spaces(spark, item, text, found):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = decontam.find_leaks(docs, spark.createDataFrame([(3, item), (4, None), (5, "?")], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == ([(1, 3)] if found else [])


def test_tokens_are_coded_together(monkeypatch):
    """Texts are cut and coded as arrays: as the expression cuts them, for every character, and without a call for each word."""
    singly = lambda text: [decontam._token_code(t) for t in decontam.TOKEN.findall(text)]
    codes = pretoken.Cache(decontam._token_code, 1 << 16)
    decontam.template(f"{ITEM} 1,234.5 It takes 12 days. Élan ǅ ² ٣ 中文", codes)
    assert not codes
    points = [p for p in range(1, 0x3000) if p not in (0x130, 0x3A3)] + list(range(0x3000, 0x1FFFF, 61))
    text = "".join(f"a{c}1{c}2 {c} " for c in map(chr, points) if not "\ud800" <= c <= "\udfff")
    assert decontam.token_codes(text, codes).tolist() == singly(text) and not codes
    units = " ".join(f"7 {w} {w.upper()}" for w in sorted(decontam.UNITS | decontam.NUMERALS))
    assert decontam.token_codes(units, codes).tolist() == singly(units)
    pick = random.Random(5)
    monkeypatch.setattr(decontam, "_PIECE", 4)
    for _ in range(2000):
        text = "".join(pick.choice("aBé1²٣.,:!?\n _中ก-ǅ𝐀x ΣİΑ ½") for _ in range(pick.randrange(60)))
        assert decontam.token_codes(text, codes).tolist() == singly(text)


def brute_leaks(doc, item, share=decontam.COVERAGE):
    """Whether a document leaks an item, by comparing every pair of windows token by token."""
    codes = pretoken.Cache(decontam._token_code, 1 << 16)
    d, t = decontam.template(doc, codes), decontam.template(item, codes)
    w = decontam.WINDOW
    if len(t.value) < w:
        n = len(t.value)
        return n > 0 and any((d.value[p : p + n] == t.value).all() for p in range(len(d.value) - n + 1))
    same = lambda p, a, form: all(getattr(d, form)[p + j] == getattr(t, form)[a + j] for j in range(w))
    plain = lambda x, p: sum(x.slot[p + j] in (0, 3) for j in range(w)) >= decontam.LEAST_WORDS
    named = lambda x, p: sum(x.slot[p + j] == 0 for j in range(w)) >= decontam.LEAST_WORDS and any(x.slot[p + j] == 3 for j in range(w))
    lines = {}
    for p in range(len(d.value) - w + 1):
        for a in range(len(t.value) - w + 1):
            if (same(p, a, "value") and not plain(d, p) and not plain(t, a)) or (same(p, a, "caseless") and plain(d, p) and plain(t, a)) or (same(p, a, "typed") and named(d, p) and named(t, a)):
                lines.setdefault(p - a, []).append(a)
    covered = set()
    for shift, starts in lines.items():
        slots = {}
        for i in {a + j for a in starts for j in range(w)}:
            kind = max(t.slot[i], d.slot[i + shift])
            if kind:
                slots[i] = (kind, int(t.value[i]), int(d.value[i + shift]))
        pairs = set(slots.values())
        clash = {i for i, (k, x, y) in slots.items() if len({q for q in pairs if q[0] == k and q[1] == x}) > 1 or len({q for q in pairs if q[0] == k and q[2] == y}) > 1}
        for a in starts:
            span = range(a, a + w)
            if all(t.value[i] == d.value[i + shift] for i in span) or not clash & set(span):
                covered |= set(span)
    return len(covered) >= share * len(t.value)


def test_leaks_equal_brute_force(spark, sf_dir, docs, texts):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    kept = decontam.drop_leaked(docs, bench)
    assert kept.count() == docs.count() - len({d for d, _ in got}) and kept.columns == docs.columns
    short = {d: t for d, t in texts.items() if len(t or "") < 500}
    assert {p for p in got if p[0] in short} == {(d, i) for d, t in short.items() for i, x in items.items() if brute_leaks(t or "", x)}


def test_changed_questions_equal_brute_force(spark):
    """Templates, names, units, number words and slots in conflict, in random mixtures."""
    rng = random.Random(8)
    pick = lambda: [rng.choice(["Tom", "Ann", "the", "pears", "5", "7", "seven", "twenty five", "kg", "sold", "for", ".", "bought", "12"]) for _ in range(rng.randrange(3, 14))]
    items = [pick() for _ in range(12)]
    docs = []
    for _ in range(120):
        words = [w if rng.random() > 0.15 else rng.choice(["Tom", "Eve", "9", "pears", "six"]) for w in rng.choice(items)]
        docs.append(" ".join([*pick(), ".", *words, *pick()]))
    rows, bench = list(enumerate(docs)), [(i, " ".join(x)) for i, x in enumerate(items)]
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = {(d, i) for d, t in rows for i, x in bench if brute_leaks(t, x)}
    assert got == want and len(want) > 20


def test_number_words_and_whole_short_items(spark):
    item = "How many apples are left if five of the twenty apples in the basket are eaten?"
    docs = spark.createDataFrame([(1, item.replace("five", "seven").replace("twenty", "thirty-one")), (2, item.replace("five", "5").replace("twenty", "20")), (3, "Capital of France?"), (4, "the basket is eaten")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "Capital of France?")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()} == {(1, 7), (2, 7), (3, 8)}


def test_leaked_rows_go_by_text(spark):
    docs = spark.createDataFrame([(7, ITEM), (7, "a clean text of some words"), (None, ITEM), (None, "another clean text")], "doc_id long, text string")
    kept = decontam.drop_leaked(docs, spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id long, text string"))
    assert sorted(r.text for r in kept.collect()) == ["a clean text of some words", "another clean text"]


def test_leak_edges(edge, none, spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontam.find_leaks(edge, empty).count() == 0 and decontam.find_leaks(none, some).count() == 0
    assert decontam.drop_leaked(edge, some).count() == len(EDGE)


# -- quality


def test_binomial_bound(spark):
    for k, n, p in ((0, 50, 0.05), (3, 200, 0.02), (40, 1000, 0.05)):
        got = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert got == pytest.approx(sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)), rel=1e-9)


def test_cutoffs_need_evidence_and_limit_rejections(spark):
    zero = {c: 0 for c in ("m_lines", "m_repeat", "m_marks")}
    rows = [dict(doc_id=k, lang="en", base_failed=False, m_symbols=250 if k % 20 == 0 else 10, **zero) for k in range(4000)] + [dict(doc_id=9000 + k, lang="fr", base_failed=False, m_symbols=10, **zero) for k in range(50)]
    measured = spark.createDataFrame(rows)
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    got = {r.stratum: r for r in quality.thresholds(measured, labels).collect()}
    assert (got["en"].cut_symbols, got["en"].cut_marks) == (300, 300) and got["fr"].cut_symbols is None  # a twentieth of the good rows is above 200


def test_quality_edges(edge, none, spark):
    labels = spark.createDataFrame([(3, 1), (4, 1), (None, 1), (4, 0)], "doc_id long, quality int")
    got = quality.quality_report(edge, labels).collect()
    assert len(got) == len(EDGE) and not any(r.kept for r in got)
    kept = quality.keep_good(edge, labels)
    assert kept.columns == edge.columns and kept.count() == 0
    assert quality.quality_report(none, labels).count() == 0 and quality.keep_good(none, labels).count() == 0


# -- the pipeline


def test_pipeline(spark, sf_dir, docs, tokenizer):
    """Each stage against a plain version of its decision."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    stage = docs
    for name, run in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id: r for r in stage.collect()}
        stage, _ = materialize(run(spark, stage, sf_dir), "test")
        after = {r.doc_id: r for r in stage.collect()}
        assert stage.columns == docs.columns and set(after) <= set(before)
        if name.startswith("quality"):
            report = quality.quality_report(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert set(after) == {r.doc_id for r in report.where("kept").collect()}
        elif name.startswith("simhash"):
            ids = sorted(before)
            label = brute_classes([before[i].text for i in ids])
            assert set(after) == {ids[k] for k in set(label)}
        elif name.startswith("secret"):
            assert set(after) == set(before) and not any(re.search("[0-9a-f]{16}|AKIA[A-Z0-9]{14}", r.text or "") for r in after.values())
        else:
            assert all(after[i] == before[i] for i in after)
    encoded = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert encoded == {i: tokenizer.encode(r.text, add_special_tokens=False).ids for i, r in after.items()}


def test_pipeline_edges(spark, sf_dir, tokenizer, tmp_path):
    """Null and shared ids, repeated rows, null, empty and very long texts, extra columns, an empty table."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    words = [f"word{k}" for k in range(400)]
    one, two, three = " ".join(words[:60]), " ".join(words[100:160]), " ".join(words[200:260])
    long = " ".join(f"w{k}x" for k in range(40_000))
    rows = [(1, one, "en"), (1, one, "en"), (1, two, "en"), (2, one + " more", None), (None, three, "en"), (None, three, "en"), (3, None, "en"), (4, "", None), (5, long, "xx"), (6, "short", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOC).withColumn("class", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("a", F.lit(2))
    stage = docs
    for _, run in corpus_pipeline.STAGES[:4]:
        stage, _ = materialize(run(spark, stage, sf_dir), "edges")
        assert stage.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text[:9]) for r in stage.collect()) == sorted([(1, one[:9]), (1, two[:9]), (0, three[:9]), (5, long[:9])])
    assert {r.doc_id for r in corpus_pipeline.STAGES[4][1](spark, stage, sf_dir).collect()} == {1, None, 5}
    nothing = docs.where("false")
    for _, run in corpus_pipeline.STAGES:
        nothing, _ = materialize(run(spark, nothing, sf_dir), "nothing")
        assert nothing.count() == 0


def test_duckdb_is_there():
    assert duckdb.sql("select 1").fetchall() == [(1,)]
