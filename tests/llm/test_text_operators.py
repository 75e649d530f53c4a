import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chargetrail.llm import chunked_bpe, exact_dedup, mixing, near_dedup, passages, token_files
from chargetrail.llm.components import connected_components
from chargetrail.llm.registry import prepared
from chargetrail.llm.words import Words, runs
from tests.llm.conftest import texts

SPACE = "[\x20\x09-\x0d]+"


def by_id(df, *columns):
    return Counter((r["doc_id"], *[r[c] for c in columns]) for r in df.collect())


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def test_word_hashes_depend_on_the_word_alone():
    found = Words(["one two", None, "two\tone x" + "y" * 300, "x" + "y" * 299], lower=True)
    h = found.hashes()
    assert found.first.tolist() == [0, 2, 2, 5, 6]
    assert h[0] == h[3] and h[1] == h[2] and len(set(h.tolist())) == 4
    assert runs(h, 2)[0] != runs(h, 2)[2]
    assert found.text(0, 2) == b"one two"


def test_exact_groups(docs, no_docs):
    norm = [(i, re.sub(SPACE, " ", t or "")) for i, t in texts()]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    wanted = Counter()
    for i, t in norm:
        keep = min((x for x in groups[t] if x is not None), default=None)
        wanted[i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    got = exact_dedup.exact_groups(docs, digest="sha")
    assert by_id(got, "keep_id", "group_size", "kept", "sha") == wanted
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, _, _, kept, _ in wanted.elements() if kept or i is None)
    assert exact_dedup.exact_groups(no_docs).isEmpty()


def test_exact_dedup_runs_no_python(docs):
    plan = exact_dedup.exact_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing(docs, no_docs):
    rows = mixing.mix_sources(docs).collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += len(words(r["text"]))
    got = sorted({(r["source_size"], round(r["target"], 6)) for r in rows})
    assert got == sorted({(size, round(target, 6)) for size, target in filled(sizes).values()})
    assert all(r["copies"] <= 2 for r in rows) and len(rows) == docs.count()
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_sources(docs.repartition(5)).collect()))
    emitted = mixing.emit_mix(docs)
    assert emitted.columns == docs.columns
    wanted = Counter()
    for r in rows:
        wanted[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in emitted.collect()) == +wanted
    assert mixing.mix_sources(no_docs).isEmpty() and mixing.emit_mix(no_docs).isEmpty()


def filled(sizes):
    """Targets by lifting the water level step by step."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    full, budget = set(), 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in sizes if s not in full]
        level = (budget - sum(2 * sizes[s] for s in full)) / max(sum(weights[s] for s in rest), 1)
        more = {s for s in rest if weights[s] * level >= 2 * sizes[s]}
        if not more:
            return {s: (sizes[s], 2.0 * sizes[s] if s in full else weights[s] * level) for s in sizes}
        full |= more


def test_near_duplicates(docs, no_docs):
    rows = texts()
    sets = []
    for _, t in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    group = {i: i for i, _ in rows}

    def top(i):
        return i if group[i] == i else top(group[i])

    for (i, _), a in zip(rows, sets):
        for (j, _), b in zip(rows, sets):
            if a and b and None not in (i, j) and 100 * len(a & b) >= 85 * len(a | b) and top(i) != top(j):
                group[max(top(i), top(j))] = min(top(i), top(j))
    wanted = Counter((i, len(s), top(i), i == top(i)) for (i, _), s in zip(rows, sets))
    got = near_dedup.near_duplicates(docs)
    assert by_id(got, "n_shingles", "component_id", "kept") == wanted
    assert near_dedup.near_duplicates(no_docs).isEmpty()
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns and left.where("doc_id BETWEEN 100 AND 129").isEmpty()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 300)] + [(500, 500)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 300)}}


def test_repeated_passages(docs, no_docs):
    rows = [(float("inf") if i is None else i, i, words(t)) for i, t in texts()]
    first = {}
    for order, _, w in rows:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(order, first.get(key, order))
    wanted = Counter()
    for order, i, w in rows:
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < order:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        wanted[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert by_id(passages.repeated_passages(docs), "n_words", "n_removed", "kept_sha256") == wanted
    kept = passages.repeated_passages(docs, texts=True).where("doc_id = 3").first()["kept_text"]
    assert kept == "before after that"
    assert passages.repeated_passages(no_docs).isEmpty()


def as_bytes(ids):
    return np.asarray(ids, dtype="<u4").tobytes()


def test_chunked_bpe_equals_the_library(docs, no_docs):
    spec = chunked_bpe.tokenizer_spec("word_bpe_49k.json")
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for i, t in texts():
        ids = plain.encode(t or "", add_special_tokens=False).ids
        wanted[i, len(ids), bytes(as_bytes(ids)), plain.decode(ids, skip_special_tokens=False)] += 1
    rows = chunked_bpe.encode_and_decode(docs, spec).collect()
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in rows) == wanted
    assert chunked_bpe.encode_and_decode(no_docs, spec).isEmpty()


def test_what_a_worker_remembers_of_a_chunked_corpus_stays_small():
    """640,000 different words and all their chunks took more than 150 MB of a worker before."""
    spec = chunked_bpe.tokenizer_spec("word_bpe_49k.json")
    encoder, plain = chunked_bpe.shared_encoder(spec), Tokenizer.from_str(spec)
    letters = np.random.default_rng(6).integers(97, 123, (640_000, 6), dtype=np.uint8)
    letters[:, 5] = 32
    tracemalloc.start()
    try:
        for part in np.split(letters, 16):
            encoder.encode([part[i : i + 1000].tobytes().decode() for i in range(0, len(part), 1000)])
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 64 << 20
    texts = [letters[i : i + 500].tobytes().decode() for i in (0, 300_000, 639_000)]  # forgotten and remembered ones
    for text, (ids, decoded) in zip(texts, encoder.encode(texts)):
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids == bytes(as_bytes(want)) and decoded.decode() == plain.decode(want, skip_special_tokens=False)


def test_chunks_do_not_depend_on_what_precedes():
    body = np.frombuffer(bytes(range(32, 127)) * 40, np.uint8)
    shifted = np.concatenate([np.frombuffer(b"some other start", np.uint8), body])
    plain, moved = chunked_bpe.chunk_ends(body), chunked_bpe.chunk_ends(shifted) - 16
    assert set(plain[plain > chunked_bpe.REACH]) == set(moved[moved > chunked_bpe.REACH])


def test_orc_token_files(docs, no_docs, folder):
    spec = chunked_bpe.tokenizer_spec("byte_bpe_50k.json")
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = [(i, plain.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in texts()]
    got = token_files.tokenise_to_orc(docs, spec, f"{folder}/t").collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (i, len(x), zlib.crc32(as_bytes(x))) for i, x in coded
    )
    at = 0
    for r in sorted(got, key=lambda r: (r["doc_id"] is not None, r["start"])):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] is not None] == sorted(
        i for i, _ in coded if i is not None
    )
    scan = token_files.read_token_files(docs.sparkSession, f"{folder}/t").where("doc_id = 12")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,12)" in plan
    assert scan.first()["ids"] == dict(coded)[12]
    assert token_files.tokenise_to_orc(no_docs, spec, f"{folder}/none").isEmpty()


def test_cut_texts_have_the_ids_of_the_whole():
    spec = chunked_bpe.tokenizer_spec("byte_bpe_50k.json")
    memo, plain = token_files.WordPieces(spec), Tokenizer.from_str(spec)
    draw = random.Random(8)
    parts = ["one", " two", "Ünï", " ñé.", "\n", " ", "  ", ",", "...", " (x)", "&&&", "%", "'s", "'ll", "12", " 3.5", "中", "<|endoftext|>", "\t", "\0", "\r\n", "\u3000", "\u00a0", "a.b", "!'", "e\u0301"]
    for _ in range(4000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 14)))
        cut = token_files.cut_text(text)
        memo.learn(cut)
        assert b"".join(memo.ids[piece] for piece in cut) == bytes(as_bytes(plain.encode(text, add_special_tokens=False).ids)), repr(text)


def scanned_rows(df):
    """Rows that the scan has read from the files, after it has skipped what it could."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_orc_files_are_skipped_by_index_and_bloom_filter(spark, folder):
    docs = prepared(spark).range(0, 20_000, 2).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1)
    spec = chunked_bpe.tokenizer_spec("byte_bpe_50k.json")
    token_files.write_token_files(token_files.encode_documents(docs, spec).coalesce(1), f"{folder}/t")
    scan = token_files.read_token_files(spark, f"{folder}/t")
    jvm, name = spark._jvm, next(iter(scan.inputFiles()))
    options = jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(name), options)
    assert reader.getRowIndexStride() == token_files.ROWS_PER_INDEX and reader.getNumberOfRows() == 10_000
    assert reader.getStripes().get(0).getIndexLength() > 0
    assert scanned_rows(scan.select("doc_id", "ids")) == 10_000
    # the row index leaves the one group of rows that may hold the id
    assert scanned_rows(scan.where("doc_id = 4444").select("doc_id", "ids")) <= token_files.ROWS_PER_INDEX
    # odd ids lie within the groups' bounds: only the Bloom filter knows that they are missing
    missing = [scanned_rows(scan.where(f"doc_id = {i}").select("doc_id", "ids")) for i in range(1001, 16_001, 1500)]
    assert missing.count(0) >= len(missing) - 2


def test_starts_over_several_files_and_stripes(spark, folder, monkeypatch):
    monkeypatch.setattr(token_files, "STRIPE_BYTES", 4096)
    rows = [(None if i % 97 == 0 else i // 3, "word " * (i % 50)) for i in range(4000)]
    docs = prepared(spark).createDataFrame(rows, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = token_files.tokenise_to_orc(docs, chunked_bpe.tokenizer_spec("byte_bpe_50k.json"), f"{folder}/t").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [0, *np.cumsum([r["n_tokens"] for r in ordered])[:-1].tolist()]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert ids == sorted(ids)


def test_only_deciding_documents_are_dealt():
    """A window that all documents have is dealt once per bucket, and for its first document."""
    draw = np.random.default_rng(2)
    ids = np.concatenate([np.arange(5000), draw.integers(0, 5000, 3000), np.repeat(passages._LAST - np.arange(3), 40)])
    hashes = np.concatenate([np.full(5000, 7), draw.integers(100, 900, 3000), np.full(120, 7)]).astype(np.uint64)
    some, marks = passages._deciding(ids, hashes, 16)
    assert (marks == 7).sum() <= 16 + 1 + 3 and len(some) < len(ids) / 2

    def decided(ids, hashes):
        least, out = {}, set()
        real = [None if i > passages._NO_ID else i for i in ids.tolist()]
        for i, h in zip(real, hashes.tolist()):
            if i is not None:
                least[h] = min(least.get(h, i), i)
        for i, h, bucket in zip(real, hashes.tolist(), passages._buckets_of(ids, 16).tolist()):
            if h in least and (i is None or i > least[h]):
                out.add((h, bucket, least[h]))
        return out

    assert decided(some, marks) == decided(ids, hashes)
    assert [len(x) for x in passages._deciding(ids[:0], hashes[:0], 16)] == [0, 0]


def test_rows_without_an_id_are_spread(spark):
    rows = [(None, f"{k} " + " ".join(f"w{i}" for i in range(20))) for k in range(40)] + [(5, " ".join(f"w{i}" for i in range(20)))]
    docs = prepared(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    numbered = docs.select(passages._bucket_column(docs["doc_id"], docs["text"], 8).alias("b"))
    assert numbered.distinct().count() > 4
    got = Counter((r["doc_id"], r["n_removed"]) for r in passages.repeated_passages(docs).collect())
    assert got == {(None, 20): 40, (5, 0): 1}
