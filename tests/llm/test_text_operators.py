"""Brute-force comparisons and edge cases of the operators on texts."""

import hashlib
import random
import zlib

import pytest
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from stationflow.llm import cross_parse, exact_dedup, external_shuffle, license_scan, merkle, ngram_join, sentencepiece_trie, temperature_mix
from stationflow.llm.components import connected_components
from stationflow.llm.hash_filter import split_by_keys
from stationflow.llm.queries import sentencepiece_model

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def brute_classes(rows, width, percent):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and (100 + percent) * len(x & y) >= percent * (len(x) + len(y)):
                root[find(i)] = find(j)
    members = {}
    for k, (doc, _) in enumerate(rows):
        members.setdefault(find(k), []).append(doc)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return sorted(((d, len(s), least[find(k)] if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize("width,percent,block_rows", [(4, 85, 256), (5, 80, 4), (2, 60, 3)])
def test_classes_equal_brute_force(documents, width, percent, block_rows):
    rng = random.Random(width)
    common = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choices(common, k=rng.choice([1, 2, 3, 5, 8, 20, 60])))) for k in range(60)]
    base = [rng.choices([f"v{k}" for k in range(500)], k=n) for n in (12, 40, 150, 400)]
    for b in base:  # graded edits: a large group of near copies
        for _ in range(25):
            c = list(b)
            for _ in range(rng.randint(0, max(1, len(b) // 25))):
                c[rng.randrange(len(c))] = rng.choice(common)
            rows.append((len(rows), ("PASSAGE " * 6 if rng.random() < 0.3 else "") + " ".join(c).title()))
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one"), (1004, "ONE"), (None, rows[70][1]), (7, rows[7][1]), (1005, "x " * 3000), (1006, "ü ñ 日本\x85語 end")]
    got = ngram_join.link_classes(documents(rows), width, percent, block_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_classes(rows, width, percent)


def test_repeated_rows_in_a_large_group(documents):
    def edited(k):
        return " ".join(f"new{k}" if n == k else f"w{n}" for n in range(60))

    rows = [(k, edited(4 * k + 3)) for k in range(12)] + [(50, edited(-1))] + [(60, edited(50))] * 10 + [(None, edited(54))] * 8 + [(None, edited(56)), (70, edited(58)), (70, edited(58) + " w0 w1 w2 w3"), (70, edited(58))]
    got = ngram_join.link_classes(documents(rows), 4, 85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_classes(rows, 4, 85)
    assert {r.component_id for r in got} == {0}


def test_classes_of_no_documents(documents):
    assert ngram_join.link_classes(documents([])).count() == 0
    assert ngram_join.drop_near_copies(documents([])).count() == 0


def test_near_copies_leave_one(documents):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(3, text), (1, text + " z"), (None, text + " y"), (2, "other words here"), (2, text), (9, None), (9, "")]
    assert sorted((r.doc_id, (r.text or "")[-4:]) for r in ngram_join.drop_near_copies(documents(rows)).collect()) == [(1, "99 z"), (2, "here"), (9, ""), (9, "")]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 440)] + [(None, 1), (5, 5)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("counters", [1, 3, 1000])
def test_exact_groups(documents, counters):
    rows = [(k, f"t{min(k % 7, 2)}") for k in range(80)] + [(200, None), (201, ""), (5, "t2"), (None, "t1"), (None, "alone"), (79, "t2"), (300, "x" * 100000)]
    got = sorted((tuple(r) for r in exact_dedup.duplicate_groups(documents(rows), counters).collect()), key=str)
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    keep = {t: max((d for d in g if d is not None), default=None) for t, g in groups.items()}
    seen, want = set(), []
    for d, t in rows:
        t = t or ""
        stays = d == keep[t] and t not in seen
        if stays:
            seen.add(t)
        want.append((d, keep[t], len(groups[t]), stays, hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    left = exact_dedup.drop_duplicates(documents(rows), counters)
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str) == sorted(((k, t) for t, k in keep.items()), key=str)
    assert left.columns == documents([]).columns
    assert exact_dedup.duplicate_groups(documents([])).count() == 0


def test_frequent_keys_survive_merging(spark):
    keys = [1] * 400 + [2] * 300 + list(range(10, 310))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "key long").repartition(7)
    rows = {r.key: r.weight for r in exact_dedup.frequent(df, 4).collect()}
    assert {1, 2} <= set(rows) and len(rows) <= 4 and rows[1] <= 400


def test_fingerprints(documents):
    rows = [(5, "ab\ncd\n" * 40), (1, "x" * 301), (9, None), (3, ""), (7, "日本語é" * 50), (4, "ab\ncd\n" * 40), (None, "loose"), (8, "q")]
    got = {r.doc_id: r for r in merkle.fingerprint_edits(documents(rows)).collect()}
    order = sorted(d for d, _ in rows if d is not None)
    text = {d: t or "" for d, t in rows}
    assert len(got) == len(rows)
    for k, d in enumerate(order):
        t, nxt = text[d], text[order[(k + 1) % len(order)]]
        h = len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        assert (got[d].fingerprint == got[d].edited_fingerprint) == (t == edited)
    assert got[4].fingerprint == got[5].fingerprint and got[4].near_next == 1.0 and got[3].near_edited == 1.0
    assert merkle.fingerprint_edits(documents([])).count() == 0
    assert merkle.fingerprint_edits(documents([(1, "lone text")])).first().near_next == 1.0


def test_differing_branches(spark):
    lines = [f"line {k}\n" for k in range(60)]
    other = lines[:20] + ["changed\n"] + lines[21:45] + ["new\n"] + lines[45:]
    df = spark.createDataFrame([("".join(lines), "".join(other))], "a string, b string")
    prints = df.select(merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b"))
    r = prints.select(merkle.edited_leaves(F.col("a"), F.col("b")), merkle.edited_leaves(F.col("b"), F.col("a"))).first()
    assert list(r) == [[20], [20, 45]]


def test_shards(documents, spark, tmp_path):
    rows = [(k, "x" * (k % 50)) for k in range(200)] + [(7, "x" * 7)] * 90 + [(None, None)] * 3
    records = documents(rows).select("doc_id", "shard", (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"), F.crc32("text").alias("crc"))
    out = external_shuffle.shuffled_shards(records, 24, "size", seed=5, bucket_bytes=1000).collect()
    assert sorted(str((r.doc_id, r.size)) for r in out) == sorted(str((d, len(t or "") + 8)) for d, t in rows)
    shards = {s: sorted(r.slot for r in out if r.shard == s) for s in range(24)}
    sizes = {len(x) for x in shards.values()}
    assert max(sizes) - min(sizes) <= 1 and all(x == list(range(len(x))) for x in shards.values())
    assert external_shuffle.shuffled_shards(records.limit(0), 24, "size").count() == 0
    written = external_shuffle.write_shards(documents(rows).drop("shard"), str(tmp_path / "out"), 5, bucket_bytes=2000)
    assert written.count() == len(rows) and written.select("shard").distinct().count() == 5


def test_shuffle_query_writes_whole_documents(spark):
    from pathlib import Path

    from stationflow.llm.queries import op7_external_shuffle
    from stationflow.session import shared_dir

    folder = Path(shared_dir(spark))
    before = set(folder.glob("shards-*"))
    out = {(r.doc_id, r.shard, r.slot): (r["size"], r.text_crc32) for r in op7_external_shuffle(spark, SMALL).collect()}
    (path,) = set(folder.glob("shards-*")) - before
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    written = spark.read.parquet(str(path))
    assert sorted(map(str, written.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    told = {(r.doc_id, r.shard, r.slot): (len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in written.collect()}
    assert told == out


def test_language_on_held_out_rows(spark, documents):
    from stationflow.llm.queries import op8_cross_parse_language

    told = op8_cross_parse_language(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    share = told.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.98
    assert {r.held_out for r in told.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1} == {True}
    models = cross_parse.learn(documents([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "de"), (4, "x", None)]))
    rows = [(1, None), (2, ""), (3, "123 ..."), (4, "the dog"), (5, "die katze"), (6, "the " * 50000), (6, "q" * 300), (None, "der hund")]
    got = cross_parse.identify(documents(rows), models)
    assert [(r.doc_id, r.lang_pred) for r in got.collect()][:5] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de")]
    assert all(0 <= r.score <= 1 for r in got.collect()) and got.columns[-2:] == ["lang_pred", "score"]
    assert cross_parse.identify(documents(rows), ()).filter("lang_pred <> 'und'").count() == 0
    assert cross_parse.identify(documents([]), models).count() == 0


def test_languages_of_little_or_unspaced_training_text(spark):
    rng = random.Random(5)
    unspaced = lambda n: "".join(rng.choices("的一是不了人我在有他这中大来上国", k=n))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [(-1, "ja da", "xx"), (-2, "hello world", "yy"), (-3, "a", "zz"), (-4, unspaced(30000), "zh"), (-5, "ein wort " + "Q" * 100000, "qq")]
    models = cross_parse.learn(docs.filter(~cross_parse.held_out()).unionByName(spark.createDataFrame(rows, docs.schema)))
    size = {lang: len(text) for lang, text in models}
    assert 30000 < size["zh"] <= cross_parse.MODEL_BYTES and b" ein wort qqq" in dict(models)["qq"]
    held = docs.filter(cross_parse.held_out()).unionByName(spark.createDataFrame([(-k, unspaced(500), "zh") for k in range(1, 5)], docs.schema))
    told = cross_parse.identify(held, models)
    share = {r.lang: r.share for r in told.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("share")).collect()}
    assert min(share.values()) > 0.98, share


def greedy(text, train):
    """Phrases and unseen bytes of a greedy parse by substring search."""
    at = phrases = unseen = 0
    while at < len(text):
        k = 0
        while at + k < len(text) and text[at : at + k + 1] in train:
            k += 1
        at, phrases, unseen = at + max(k, 1), phrases + (k > 0), unseen + (k == 0)
    return phrases, unseen


def test_phrases_equal_greedy_parse():
    rng = random.Random(2)
    import numpy as np

    train = "".join(rng.choices("abc ", k=300)).encode()
    words = sorted({"".join(rng.choices("abcd ", k=rng.randint(1, 40))).encode() for _ in range(200)}, key=lambda w: (-len(w), w))
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    phrases, unseen = cross_parse.Automaton(train).parse(data, np.cumsum(sizes) - sizes, sizes)
    assert list(zip(phrases, unseen, strict=True)) == [greedy(w, train) for w in words]


def test_languages_equal_brute_force(documents, spark):
    import math

    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    models = cross_parse.learn(documents(docs[:60]), rows=8, model_bytes=3000)
    texts = [t for _, t, _ in docs[60:110]] + [None, "Ünïcode 日本語 the", "x" * 5000, "the and " * 900]
    want = []
    for text in texts:
        low = (text or "").lower().encode()
        costs = []
        for lang, train in models:
            parts = [greedy(low[k : k + cross_parse.STRETCH], train) for k in range(0, len(low), cross_parse.STRETCH)]
            costs.append((sum(p for p, _ in parts) * math.log2(len(train) + 2) + 9 * sum(u for _, u in parts), lang))
        want.append(min(costs)[1] if any(c.isalpha() for c in text or "") else "und")
    got = cross_parse.identify(documents([(k, t) for k, t in enumerate(texts)]), models).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == want


def test_texts_no_language_tells_better_than_bytes(documents):
    models = cross_parse.learn(documents([(1, "the cat and the dog " * 200, "en"), (2, "der hund und die katze " * 200, "de")]))
    rows = [(1, "the dog"), (2, "xqzj vvkpq wrrtz"), (3, "日本語"), (4, "die katze")]
    told = lambda **kw: [r.lang_pred for r in cross_parse.identify(documents(rows), models, **kw).orderBy("doc_id").collect()]
    assert told() == ["en", told()[1], "de", "de"]
    assert told(most_bits=cross_parse.LITERAL_BITS) == ["en", "und", "und", "de"]


def test_pieces_equal_the_library(spark, documents):
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_model())
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzABC  \n\t▁.,<>_éèñßüöа日本語ﬁＡ01234567890'-"
    texts = ["".join(rng.choice(letters[: rng.choice([3, 8, 30, len(letters)])]) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "  ", " ", "\n", "a" * 500, "▁▁", "the " * 20, "<s>", "<0x0A>"]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    ids = sentencepiece_trie.encode_texts(pa.array(texts), sentencepiece_model())
    assert ids.to_pylist() == sp.encode(texts, num_threads=1)
    assert sentencepiece_trie.decode_ids(ids, sentencepiece_model()).to_pylist() == [sp.decode(x) for x in ids.to_pylist()]
    rows = documents([(1, "Hello  world"), (2, None), (2, ""), (None, "x▁y")])
    got = sentencepiece_trie.encode(rows.withColumn("IDS", F.lit(1)), sentencepiece_model(), check="same")
    assert [(r.doc_id, r.n_pieces, r.same) for r in got.collect()] == [(1, len(sp.encode("Hello  world")), True), (2, 0, True), (2, 0, True), (None, len(sp.encode("x▁y")), False)]
    back = sentencepiece_trie.decode(got.select("doc_id", "ids"), sentencepiece_model())
    assert [r.decoded for r in back.collect()] == ["Hello  world", "", "", "x y"]
    assert sentencepiece_trie.encode(documents([]), sentencepiece_model()).count() == 0


def test_mixture(documents):
    rows = [(k, "w " * (1 + k % 9), None, "big" if k % 3 else "small") for k in range(300)] + [(400 + k, "a b c", None, None) for k in range(6)] + [(500, None, None, "none"), (1, "w w", None, "big"), (1, "w w", None, "big"), (None, "z", None, "small")]
    df = documents(rows)
    out = temperature_mix.mixture_order(df, 0.99, 3.0, seed=2).collect()
    sources = temperature_mix.plan_mixture(df, 0.99, 3.0, seed=2)[1].collect()
    total = sum(s.tokens for s in sources)
    weights = [s.weight for s in sources if s.tokens]
    assert abs(sum(weights) - 1) < 1e-9 and max(s.weight * total / s.tokens for s in sources if s.tokens) <= 3.0 + 1e-6
    for s in sources:
        name = None if s.unnamed else s.source
        taken = [r for r in out if r.source == name]
        used, longest = sum(r.tokens for r in taken), max((r.tokens for r in taken), default=0)
        assert used <= s.quota and (not s.tokens or used > s.quota - 10)
        for e in range(s.whole + 1):
            places = sorted(r.place for r in taken if r.epoch == e)
            assert places == list(range(len(places))) and (e == s.whole or len(places) == s.rows)
    mixed = temperature_mix.mix_documents(df, 0.99, 3.0, seed=2)
    count = lambda rs: sorted((str(r.doc_id), str(r.source)) for r in rs)
    assert count(mixed.collect()) == count(out) and mixed.columns == df.columns
    assert temperature_mix.mixture_order(documents([]), 0.9, 2.0).count() == 0
    assert temperature_mix.mix_documents(documents([]), 0.9, 2.0).count() == 0


def test_exponent_meets_entropy(spark):
    import math

    df = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, tokens long")
    w = [r.weight for r in temperature_weights_rows(df)]
    assert abs(-sum(x * math.log(x) for x in w) - 0.8 * math.log(3)) < 1e-4


def temperature_weights_rows(df):
    return temperature_mix.temperature_weights(df, 0.8, 1e9).collect()


def test_licenses(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("LICENSE", mit), ("a/LICENSE.txt", f"first line\n{gpl}"), ("a/b/c/x.py", "no notice " * 4000), ("a/b/y.py", f"# {mit}\ncode"), ("d/z.py", None),
        ("d/e/COPYING", "nothing here"), ("top.py", ""), (None, gpl), ("a/b/c/x.py", "again"), ("ab/w.py", "Licensed under something else by me."),
    ]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("line", F.lit(3)).withColumn("license", F.lit("?"))
    got = license_scan.scan_licenses(files).collect()
    told = sorted((str(r.path), r.own_license, r.license, r.inherited_from) for r in got)
    assert told == sorted([
        ("LICENSE", "MIT", "MIT", None), ("a/LICENSE.txt", "GPL-3.0", "GPL-3.0", None), ("a/b/c/x.py", None, "GPL-3.0", "a"), ("a/b/c/x.py", None, "GPL-3.0", "a"),
        ("a/b/y.py", "MIT", "MIT", None), ("d/z.py", None, "MIT", ""), ("d/e/COPYING", None, "MIT", ""), ("top.py", None, "MIT", ""), ("None", "GPL-3.0", "GPL-3.0", None), ("ab/w.py", None, "MIT", ""),
    ])
    assert license_scan.scan_licenses(files.limit(0)).count() == 0


def clashing(documents, rows):
    """Documents with columns named like every helper, a map and a name with a dot."""
    extra = ["_id", "_digest", "_source", "_copy", "_n", "_times", "_first", "_rows", "_pred", "_score", "helper", "_helper", "row", "copy", "again", "keep_id", "digest", "n", "times", "pred", "class_id"]
    df = documents(rows).withColumns({c: F.lit(k) for k, c in enumerate(extra)})
    return df.withColumn("map", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("a.b", F.lit(1))


def test_stages_with_clashing_columns(spark, documents):
    import corpus_pipeline

    text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)} the" for k in range(60))
    rows = [(1, text, "en", "web"), (2, text, "en", "web"), (2, text, "en", "web"), (3, text + " more", "en", "web"), (4, "the other words here", "en", "books"), (4, "the other words here", "en", "books"), (5, None, None, None), (6, "", "en", None), (None, "the words that have no id", "en", "web")]
    rows += [(k, f"the {chr(97 + k % 26)}word and text {text[: 30 + k]}", "en", "web") for k in range(10, 40)]
    for df in (clashing(documents, rows), clashing(documents, [])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, df, SMALL)
            assert got.columns == df.columns, name
            found = got.collect()
            assert len(found) <= 2 * df.count()
        assert corpus_pipeline.STAGES[-1][1](spark, df, SMALL).count() == df.count()
    kept = exact_dedup.drop_duplicates(clashing(documents, rows), 3)
    assert sorted(str(r.doc_id) for r in kept.collect())[:6] == sorted(str(d) for d in {2, 3, 4, 6, None, *range(10, 40)})[:6] and kept.count() == 35
    assert {r.doc_id: r.map["k"] for r in kept.collect() if r.doc_id} == {d: d for d in {2, 3, 4, 6, *range(10, 40)}}
    near = ngram_join.drop_near_copies(clashing(documents, [(1, text), (3, text + " more"), (4, "no")]))
    assert sorted(r.doc_id for r in near.collect()) == [1, 4]


def test_repeats_of_the_winner_differ_in_other_columns(documents):
    rows = [(7, "same", None, s) for s in ("c", "a", "b")] + [(3, "same", None, "z")] * 40 + [(9, "lone", None, s) for s in ("y", "x")]
    for counters in (1, 1000):
        got = exact_dedup.drop_duplicates(documents(rows).repartition(5), counters).collect()
        assert sorted((r.doc_id, r.source) for r in got) == [(7, "a"), (9, "x")]


def test_no_text_of_a_frequent_copy_is_shuffled(documents):
    rows = [(k, "copy " * 100) for k in range(500)] + [(1000 + k, f"text {k}") for k in range(40)]
    left = exact_dedup.drop_duplicates(documents(rows), 20)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
    assert left.count() == 41


def texts_exchanged(df):
    """Rows with a text that the collected `df` sent through exchanges."""
    df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        children = node.children()
        inner += [children.apply(k) for k in range(children.size())]
        own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" and "text#" in node.output().mkString(" ") else 0
        return own + sum(walk(x) for x in inner)

    return walk(df._jdf.queryExecution().executedPlan())


def test_texts_without_a_copy_meet_no_exchange(spark, documents):
    text = lambda k: " ".join(f"w{k}x{n}" for n in range(60))
    rows = [(k, text(k)) for k in range(400)] + [(1000 + k, text(k)) for k in range(9)] + [(2000 + k, text(100 + k) + " more") for k in range(7)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the copies are too many to broadcast
    try:
        once = exact_dedup.drop_duplicates(documents(rows), 3)
        assert texts_exchanged(once) < 40 and once.count() == 407
        left = ngram_join.drop_near_copies(documents([r for r in rows if not 1000 <= r[0] < 2000]))
        assert texts_exchanged(left) < 40 and sorted(r.doc_id for r in left.collect()) == list(range(400))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [1 << 27, 1 << 15])
def test_rows_are_split_by_keys_without_loss(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr("stationflow.llm.hash_filter.MOST_BITS", most)
    values = [*range(-300, 300), 2**63 - 1, -(2**63), None]
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "helper long, held long").repartition(4)
    for name, keys in (("some", [5, -7, 2**63 - 1, -(2**63), None, 5]), ("none", []), ("many", list(range(10**6, 10**6 + 20000)))):
        spark.createDataFrame([(k,) for k in keys], "key long").write.parquet(str(tmp_path / name))
        maybe, other = split_by_keys(df, F.col("helper"), spark.read.parquet(str(tmp_path / name)))
        inside, outside = ([r.helper for r in x.collect()] for x in (maybe, other))
        assert maybe.columns == other.columns == df.columns and sorted([*inside, *outside], key=str) == sorted(values, key=str)
        assert {k for k in keys if k in values and k is not None} <= set(inside) and None in outside
        if name != "many":
            assert len(inside) <= 8


def test_long_runs_merge_in_time():
    import time

    from stationflow.llm.sentencepiece_trie import MARK, load, merge

    def slow(text, rank):
        parts = list(text)
        while True:
            found = min(((rank[a + b][0], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank), default=None)
            if found is None:
                return parts
            k = found[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    rank = load(sentencepiece_model()).rank
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 17, 40, 100):
        for alphabet in (MARK, MARK + "a", "abcdeo" + MARK, "=-_. "):
            text = "".join(rng.choices(alphabet, k=n))
            assert merge(text, rank) == slow(text, rank)
    began = time.time()
    assert "".join(merge(MARK * 100000, rank)) == MARK * 100000 and time.time() - began < 20
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_model())
    text = "a" + " " * 100000 + "b"
    assert sentencepiece_trie.encode_texts(pa.array([text]), sentencepiece_model()).to_pylist() == [sp.encode(text)]


def test_real_licence_texts(spark):
    text = dict.fromkeys(n for n, _ in license_scan.TEMPLATES)
    for name, t in license_scan.TEMPLATES:
        text[name] = max(text[name] or "", t, key=len)

    def wrapped(t, mark=""):
        import textwrap

        return "".join(f"{mark}{row}\n" for row in textwrap.wrap(t, 66))

    code = "import zyx\n\ndef frob(quux):\n    return quux * 17  # plugh xyzzy\n" * 8
    rows = [
        ("apache/LICENSE", "\n                              Apache License\n                        Version 2.0, January 2004\n                     http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n" + "plain other words of the terms\n" * 60, "Apache-2.0"),
        ("spdx/a.c", "// SPDX-License-Identifier: Apache-2.0\n" + code, "Apache-2.0"),
        ("spdx/b.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */\n" + code, "GPL-2.0"),
        ("spdx/c.c", "# SPDX-License-Identifier: MIT\n" + code, "MIT"),
        ("gpl3/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy\n" + code, "GPL-3.0"),
        ("gpl2/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n" + code, "GPL-2.0"),
        ("gpl3/x.py", "#!/usr/bin/env python\n# Frobnicate quuxes.\n#\n" + wrapped(text["GPL-3.0"], "# ") + code, "GPL-3.0"),
        ("agpl/x.py", code + wrapped(text["AGPL-3.0"], " * ") + code, "AGPL-3.0"),
        ("bsd3/x.c", code + wrapped(text["BSD-3-Clause"], " * ") + code, "BSD-3-Clause"),
        ("bsd2/LICENSE", "Copyright (c) 2020, A. Person\nAll rights reserved.\n\n" + wrapped(text["BSD-2-Clause"]), "BSD-2-Clause"),
        ("mit/LICENSE", "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + wrapped(text["MIT"]), "MIT"),
        ("apache/x.py", wrapped(text["Apache-2.0"], "# ") + code, "Apache-2.0"),
        ("plain/x.py", code + "the use of this license is not what this file is about\n", None),
    ]
    files = spark.createDataFrame([r[:2] for r in rows] + [(f"pad/{k}", f"some words number {k} and the rest of it") for k in range(200)], "path string, text string")
    got = {r.path: r for r in license_scan.scan_licenses(files).collect()}
    assert {p: got[p].own_license for p, _, _ in rows} == {p: want for p, _, want in rows}
    assert got["spdx/a.c"].line == 0 and got["agpl/x.py"].line >= 30


def test_licence_cosines_equal_brute_force(spark):
    import math
    import re
    from collections import Counter

    rng = random.Random(8)
    templates = [("A", "one two three three four"), ("B", "two five six"), ("C", "one seven")]
    vocabulary = "one two three four five six seven other thing".split()
    texts = ["\n".join(" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 7]))) for _ in range(rng.choice([1, 2, 5, 40]))) for _ in range(60)] + ["", "one", "\n\n"]
    known = {w for _, t in templates for w in t.split()}
    words = lambda t: re.findall("[a-z]+", t)
    df = Counter(w for t in texts for w in set(words(t)) & known)
    idf = lambda w: math.log((len(texts) + 1) / ((df[w] if w in known else 0) + 1)) + 1

    def cosine(found, template):
        tf, of = Counter(found), Counter(words(template))
        mine = sum((n * idf(w)) ** 2 if w in known else n * idf(w) ** 2 for w, n in tf.items())
        return sum(tf[w] * of[w] * idf(w) ** 2 for w in of) / math.sqrt(mine * sum((n * idf(w)) ** 2 for w, n in of.items())) if tf else 0.0

    got = {int(r.path): r for r in license_scan.own_licenses(spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "path string, text string"), templates).collect()}
    for k, text in enumerate(texts):
        lines = [words(x) for x in text.split("\n")]
        spans = [sum(lines[i : i + n], []) for n in license_scan.WINDOWS for i in range(len(lines) - n + 1) if lines[i]] + [words(text)]
        best = max(cosine(s, t) for s in spans for _, t in templates)
        assert abs(got[k].similarity - (best if best >= 0.6 else 0.0)) < 1e-8, (k, text)
        if best >= 0.6:
            r = got[k]
            span = words(text) if r.line < 0 else sum(lines[r.line : r.line + r.lines], [])
            assert max(cosine(span, t) for name, t in templates if name == r.own_license) >= best - 1e-8
