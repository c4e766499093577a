"""Conversation tries, content-addressed archives and phrase mining against brute force, with their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from pagelake.llm import collocations, prefix_trie, warc_store
from pagelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("name, table", [("op11_collocations", "documents"), ("op12_warc", "pages"), ("op13_prefix_trie", "conversations")])
def test_query_equals_its_sql(spark, name, table):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(ORACLES[name])
    order = sorted(range(len(want.columns)), key=lambda k: want.columns[k])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == Counter(tuple(r[k] for k in order) for r in want.fetchall())


# ---------------------------------------------------------------- conversations
TALK = "conv_id long, turn long, role string, text string"


def plain_trie(members):
    """members: conv_id -> tuple of (role, text). Every node by listing all prefixes."""
    nodes = defaultdict(list)
    for conv, path in members.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(conv)
    out = []
    for node, convs in nodes.items():
        under = [x for x in nodes if x[: len(node)] == node]
        children = [x for x in under if len(x) == len(node) + 1]
        leaves = [x for x in under if not any(len(y) > len(x) and y[: len(x)] == x for y in under)]
        saved = sum((len(nodes[x]) - 1) * len(x[-1][1]) for x in under if x)
        ends = ",".join(str(c) for c in sorted(convs) if members[c] == node)
        out.append((min(convs), len(node), min(nodes[node[:-1]]) if node else None, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def plain_rebuilt(rows):
    """The contract's rebuilding, row by row."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    out = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + said[h:])
    return out


def talk_rows(seed, convs=60, step=7):
    rnd = random.Random(seed)
    rows = []
    for c in range(0, convs * step, step):
        for t in range(rnd.randint(1, 8)):
            rows.append((c, t if t else None, rnd.choice(["user", "bot", None]), rnd.choice(["hi", "yo\U0001f600", "", None, "long text"]) if t > 1 else "same"))
    rnd.shuffle(rows)
    return rows


def as_rows(df):
    return Counter(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


@pytest.mark.parametrize("per_shard, limit", [(1 << 20, 1 << 16), (3, 1 << 16), (1, 1 << 16), (3, 5)])
def test_trie_against_all_prefixes(spark, per_shard, limit):
    rows = talk_rows(per_shard)
    df = spark.createDataFrame(rows, TALK)
    said = prefix_trie.rebuilt(df)
    assert as_rows(prefix_trie.nodes(prefix_trie.paths(said), per_shard, limit)) == plain_trie(plain_rebuilt(rows))


def test_trie_one_conversation_shared_by_most_and_long_common_start(spark):
    """Two thirds of the conversations are equal, others share their first 40 turns."""
    same = [(t, "u", f"t{t}") for t in range(40)]
    rows = [(c, *x) for c in range(2, 500, 2) for x in same] + [(c, t, "u", f"t{t}" if t < 40 else f"own{c}") for c in range(1, 240, 2) for t in range(42)]
    df = spark.createDataFrame(rows, TALK)
    members = defaultdict(list)
    for c, _, r, t in rows:
        members[c].append((r, t))
    # nodes along the shared start are few, so brute force stays small
    got = as_rows(prefix_trie.trie(df, per_shard=50))
    want = plain_trie({c: tuple(x) for c, x in members.items()})
    assert got == want


def test_trie_defined_cases(spark):
    assert prefix_trie.query(spark.createDataFrame([], TALK)).count() == 0
    assert prefix_trie.query(spark.createDataFrame([(None, 1, "a", "b")], TALK)).count() == 0
    # conversation 7 has fewer turns than its h and no first conversation: it ends at the root
    few = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(few, 0, "u", "x"), (few, 0, "u", "x"), (None, None, None, None)][: 1] + [(None, 0, "u", "x")]
    got = prefix_trie.query(spark.createDataFrame(rows, TALK)).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_leaves, r.ends_sha256) for r in got] == [(few, 0, 1, 1, hashlib.sha256(str(few).encode()).hexdigest())]
    rows = talk_rows(5, 20, 3)
    df = spark.createDataFrame(rows, TALK)
    clash = df.select("*", *[F.lit(k).alias(n) for k, n in enumerate("head own said path sizes pkey n conv sha shard node first h key size depth".split())])
    assert as_rows(prefix_trie.query(clash)) == as_rows(prefix_trie.query(df)) == plain_trie(plain_rebuilt(rows))


def test_ends_digest_over_many_runs(spark):
    ids = [*range(0, 20_000, 3), 10**12]
    df = spark.createDataFrame([(c, 0, "u", "x") for c in ids], TALK)
    got = {r.depth: r.ends_sha256 for r in prefix_trie.trie(df).collect()}
    assert got == {0: hashlib.sha256(b"").hexdigest(), 1: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()}


def test_splitters_cut_into_even_parts_and_the_skeleton_is_bounded():
    rnd = random.Random(1)
    turn = lambda k: hashlib.md5(str(k).encode()).digest()
    sample = [b"".join(turn(rnd.randint(0, 3)) for _ in range(rnd.randint(0, 12))) for _ in range(3_000)]
    cuts = prefix_trie.splitters(sample, 16)
    assert cuts == sorted(set(cuts)) and len(cuts) == 15
    from bisect import bisect_right
    load = Counter()
    for p in set(sample):
        load[bisect_right(cuts, p)] += len(p) + 1
    assert max(load.values()) < 1.5 * sum(load.values()) / 16
    for limit in (1, 4, 40):
        cuts, trie = prefix_trie.skeleton(sample, 64, limit)
        assert len(trie) <= limit


# ---------------------------------------------------------------- archives
PAGE = "page_id long, url string, html string"
HTML = "<p>" + "x" * 120 + "é\U0001f600</p>"
PAGES = [(3, "http://a/3", HTML), (1, "http://a/1", HTML), (2, None, HTML), (None, "http://a/n", HTML), (1, "http://a/1", HTML), (4, "http://a\r\nEvil: 1/ b", "short"), (5, "u", "short"),
         (6, "u", None), (7, "u", ""), (8, "u", "y" * 99), (9, "u", "y" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100), (-12, "u", "é" * 50), (13, "u", "é" * 50)]


def test_archive_round_trip(spark, tmp_path):
    root = warc_store.write(spark.createDataFrame(PAGES, PAGE), str(tmp_path / "a"))
    stored = [bytes(r.payload) for r in warc_store.read_payloads(spark, root).collect()]
    assert Counter(stored) == Counter({(h or "").encode(): 1 for *_, h in PAGES})  # every payload once
    got = warc_store.records(spark, root).collect()
    assert len(got) == len(PAGES) and len({r.record_id for r in got}) == len(PAGES)
    assert Counter((r.page_id, bytes(r.payload)) for r in got) == Counter((p, (h or "").encode()) for p, _, h in PAGES)
    for r in got:  # the original bytes parse as one WARC record whose length is right
        raw = bytes(r.record)
        head, rest = raw.split(b"\r\n\r\n", 1)
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and "Evil" not in fields
        block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
        assert end == b"\r\n\r\n" and fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest()
        assert block.split(b"\r\n\r\n", 1)[1] == (bytes(r.payload) if fields["WARC-Type"] == "response" else b"")
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")
        assert bytes(r.header) + (bytes(r.payload) if fields["WARC-Type"] == "response" else b"") + b"\r\n\r\n" == raw


def test_archive_query_cases(spark):
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc_store.query(spark.createDataFrame(PAGES, PAGE)).collect())
    n = len(HTML.encode())
    assert got == Counter([(1, n, "response", None), (1, n, "revisit", 1), (2, n, "revisit", 1), (3, n, "revisit", 1), (None, n, "revisit", 1), (4, 5, "response", None), (5, 5, "response", None),
                           (6, 0, "response", None), (7, 0, "response", None), (8, 99, "response", None), (9, 99, "response", None), (10, 100, "response", None), (11, 100, "revisit", 10),
                           (-12, 100, "response", None), (13, 100, "revisit", -12)])
    clash = spark.createDataFrame(PAGES, PAGE).select("*", *[F.lit(k).alias(c) for k, c in enumerate(("row", "payload", "payload_digest", "first", "head", "revisit", "n"))])
    assert rows_of(warc_store.query(clash)) == rows_of(warc_store.query(spark.createDataFrame(PAGES, PAGE)))
    assert warc_store.query(spark.createDataFrame([], PAGE)).count() == 0


def test_archive_tells_a_changed_payload(spark, tmp_path):
    root = warc_store.write(spark.createDataFrame(PAGES, PAGE), str(tmp_path / "a"))
    changed = spark.read.parquet(f"{root}/payloads").withColumn("payload", F.when(F.octet_length("payload") == 99, F.lit(b"z")).otherwise(F.col("payload")))
    changed.write.parquet(str(tmp_path / "b" / "payloads"))
    spark.read.parquet(f"{root}/headers").write.parquet(str(tmp_path / "b" / "headers"))
    with pytest.raises(Exception, match="payload differs from its digest"):
        warc_store.records(spark, str(tmp_path / "b")).count()
        warc_store.records(spark, str(tmp_path / "b")).select("record").collect()


# ---------------------------------------------------------------- phrases
DOCS = "doc_id long, text string, lang string, source string"


def plain_collocations(docs, least, top=collocations.TOP, cover=collocations.COVER):
    """Counts of all phrases by listing them; docs: (text, lang)."""
    f, total = Counter(), Counter()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", (text or "").translate(fold)):
            w = re.findall("[^ \\t]+", piece)
            total[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    cand = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    longer = Counter()
    for (lang, *p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                key = (lang, *p[i : i + m])
                longer[key] = max(longer[key], a)
    for (lang, *p), a in cand.items():
        score, _, l, r = min((2_000_000 * a // (f[(lang, *p[:k])] + f[(lang, *p[k:])]), k, f[(lang, *p[:k])], f[(lang, *p[k:])]) for k in range(1, len(p)))
        if 100 * longer[(lang, *p)] < cover * a:
            out.append((lang, " ".join(p), a, l, r, total[lang], score))
    rows = []
    for lang in {x[0] for x in out}:
        some = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        rows += [(x[0], k + 1, *x[1:]) for k, x in enumerate(some)]
    return Counter(rows)


def as_phrases(df):
    return Counter(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrase_docs(seed, n=120):
    rnd = random.Random(seed)
    words = "the The a of é \U0001f600 x\u00a0y new york city b-c 12 #".split(" ")
    text = lambda: "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", ";", "\v", "? "]) for _ in range(rnd.randint(0, 120)))
    return [(text(), rnd.choice(["en", "en", "fr", None, "und", ""])) for _ in range(n)]


@pytest.mark.parametrize("least, keys, block", [(2, 1 << 20, 1 << 20), (5, 0, 1 << 20), (3, 0, 300), (30, 5, 2_000)])
def test_collocations_against_all_phrases(spark, least, keys, block, monkeypatch):
    docs = phrase_docs(least) + [(None, "en"), ("", None), ("new york city " * 400, "en"), ("new york city, " * 50, "en")]
    df = spark.createDataFrame([(k, t, lang, None) for k, (t, lang) in enumerate(docs)], DOCS)
    monkeypatch.setattr(collocations, "BLOCK", block)
    got = as_phrases(collocations.collocations(df, least=least, keys=keys))
    assert got and got == plain_collocations(docs, least)


def test_collocations_top_and_defined_cases(spark):
    docs = phrase_docs(9, 60)
    df = spark.createDataFrame([(None, t, lang, None) for t, lang in docs], DOCS)
    assert as_phrases(collocations.collocations(df, least=2, top=7)) == plain_collocations(docs, 2, top=7)
    clash = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate("block words hashes codes at w1 w2 a l r n score rank phrase longer key known".split())])
    assert as_phrases(collocations.collocations(clash, least=2, top=7)) == plain_collocations(docs, 2, top=7)
    assert collocations.query(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.query(spark.createDataFrame([(1, None, None, None), (2, " \t. ", "en", None), (3, "one", None, None)], DOCS)).count() == 0
    many = [("to be or not to be " * 10_000, "en")] * 2  # a long text, repeated
    df = spark.createDataFrame([(1, t, lang, None) for t, lang in many], DOCS)
    assert as_phrases(collocations.query(df)) == plain_collocations(many, 30)


def test_steps_leave_no_shuffle_files(spark, tmp_path):
    """a written relation's shuffle goes with its step, and the session's setting comes back."""
    storage = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {b.toString() for b in (x.next() for x in [storage.getAllBlocks().iterator()] for _ in iter(x.hasNext, False)) if b.isShuffle()}
    before, set_before = held(), spark.conf.get(collocations.CLEANUP, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("id").alias("n"))
    assert sorted(tuple(r) for r in collocations._written(rows, str(tmp_path), "a").collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]
    assert held() <= before and spark.conf.get(collocations.CLEANUP, None) == set_before
    spark.conf.set(collocations.CLEANUP, "false")
    try:
        collocations._written(rows, str(tmp_path), "b")
        assert spark.conf.get(collocations.CLEANUP) == "false" and held() <= before
    finally:
        spark.conf.unset(collocations.CLEANUP)


def test_a_relation_goes_when_the_next_is_written(spark, tmp_path):
    """at the end only counts and the frequent words are kept, whole."""
    docs = phrase_docs(4, 40) + [("new york city " * 40, "en")]
    words, known, counts = collocations.frequent(spark.createDataFrame([(k, t, lang, None) for k, (t, lang) in enumerate(docs)], DOCS), 3, root=str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["counts-1", "counts-2", "counts-3", "counts-4", "frequent-words", "frequent-words-numbered"]
    assert words.count() >= known.count() == counts[0].count() > 0 and all(c.count() for c in counts)


def test_score_is_exact_beyond_64_bits(spark):
    big = 1 << 60
    counts = [spark.createDataFrame([(1, big + 1), (2, big + 3)], "w1 long, a long"),
              spark.createDataFrame([(1, 2, big)], "w1 long, w2 long, a long")]
    assert collocations.scored(counts, 2).first().score == 2_000_000 * big // (2 * big + 4)


def test_words_that_share_a_hash_fail(spark, monkeypatch):
    """Hashes in the blocks that don't tell words apart: the kept occurrences outnumber the counts."""
    import xxhash

    whole = xxhash.xxh64_intdigest
    df = spark.createDataFrame([(1, "often often often seldom", "en", None)], DOCS)
    blocks = collocations.occurrences(df).collect()
    hashes = collocations.unpacked(blocks[0].hashes, collocations.np.uint64)
    words = {r.word: r for r in collocations.word_counts(collocations.occurrences(df)).collect()}
    assert [words[w].w1 % 2**64 for w in blocks[0].words.decode().split()] == hashes.tolist()
    assert words["often"].a == 3 and words["often"].w1 % 2**64 == whole(b"often", whole(b"en", 42))
    same = collocations.packed(collocations.np.full(2, words["often"].w1).view(collocations.np.uint64))
    monkeypatch.setattr(collocations, "occurrences", lambda docs: spark.createDataFrame([(blocks[0].block, "en", blocks[0].words, same, blocks[0].codes)], "block long, lang string, words binary, hashes binary, codes binary"))
    with pytest.raises(ValueError, match="share a hash"):
        collocations.frequent(df, 3)  # one of them is frequent
    # both are frequent: the counts add up, the hashes aren't different
    monkeypatch.setattr(collocations, "word_counts", lambda blocks: spark.createDataFrame([(1, "en", words["often"].w1, w, n) for w, n in (("often", 3), ("seldom", 1))], "lk long, lang string, w1 long, word string, a long"))
    with pytest.raises(ValueError, match="share a hash"):
        collocations.frequent(df, 1)
