import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from chargetrail.llm import lexical_search, token_alignment, tree_bpe
from chargetrail.llm.chunked_bpe import tokenizer_spec
from chargetrail.llm.queries import QUERIES
from chargetrail.llm.registry import read
from tests.llm.conftest import texts

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = [
    (1, "W1 w2, w3 nobody"),
    (2, "one TWO Ünï çødé"),
    (3, "w1 w1 w1 a one"),
    (3, "words end"),
    (4, None),
    (5, " \n.,"),
    (None, "long1 of7 A"),
    (6, "absent"),
]


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def ranking(rows, items, k):
    """Every document scored for every item."""
    bags = [Counter(terms(t)) for _, t in rows]
    total = sum(sum(bag.values()) for bag in bags)
    count = sum(1 for bag in bags if bag)
    holders = Counter(term for bag in bags for term in bag)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = Counter()
    for item, own in wanted.items():
        scored = []
        for (doc, _), bag in zip(rows, bags):
            m = 10 + (90 * sum(bag.values()) * count) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * holders[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in own
                if t in bag
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, row in enumerate(sorted(scored)[:k], 1):
            out[item, rank, row[3], -row[0]] += 1
    return out


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block", [1, 1 << 20])
@pytest.mark.parametrize("k", [3, 10, 100])
def test_ranked_search(spark, docs, k, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS score")
    got = found(lexical_search.ranked_search(docs, items, k, block_chars=block))
    assert got == ranking(texts(), ITEMS, k)
    assert any(key[2] is None for key in got)


def test_ranked_search_of_nothing(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.ranked_search(no_docs, items).isEmpty()
    assert lexical_search.ranked_search(docs, items.limit(0)).isEmpty()


def test_large_sums_are_exact_and_small_slices_change_nothing(docs, spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(lexical_search, "CELLS", 1)
    monkeypatch.setattr(lexical_search, "GATHERED", 1)
    assert found(lexical_search.ranked_search(docs, items, 2)) == ranking(texts(), ITEMS, 2)


def test_equal_bags_are_scored_once(spark, monkeypatch):
    rows = [(i, "alpha beta alpha" if i % 3 else f"gamma {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    bags = lexical_search._bags(docs.selectExpr("doc_id _id", "text _text"), {b"alpha": 0, b"gamma": 1})
    classes = lexical_search._classes(bags, 300, 800, 4).collect()
    assert sorted([m["id"] for m in c["members"]] for c in classes) == [[0, 3, 6, 9], [1, 2, 4, 5]]
    items = spark.createDataFrame([(7, "alpha gamma 30")], "item_id long, text string")
    assert found(lexical_search.ranked_search(docs, items, 5)) == ranking(rows, [(7, "alpha gamma 30")], 5)


@pytest.fixture(scope="module")
def ranks():
    return tree_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_tree_encoding(docs, no_docs, ranks):
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for leaf in (1, 50, tree_bpe.LEAF):
        rows = tree_bpe.tree_encode(docs.where("doc_id IS NULL OR doc_id NOT IN (10, 11)") if leaf == 1 else docs, ranks, leaf=leaf).collect()
        wanted = Counter((i, tuple(whole.encode_ordinary(t or "")), (t or "").encode()) for i, t in texts() if leaf > 1 or i not in (10, 11))
        assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in rows) == wanted
        assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert tree_bpe.tree_encode(no_docs, ranks).isEmpty()


def test_tree_joins_anywhere(ranks):
    encoder = tree_bpe.TreeEncoder(ranks)
    draw = random.Random(5)
    alphabet = [*"ab'stredvml 09\n\t.,!-é中。 　", "́", "‍", "٣", "Ⅷ", "½", "\U0001f600", "'ll", "'re", "   "]
    for _ in range(5000):
        text = "".join(draw.choices(alphabet, k=draw.randint(0, 80)))
        ids, data = encoder.encode(text, draw.choice([1, 2, 3, 7, 20]))
        assert ids == encoder.encoding.encode_ordinary(text) and data == text.encode()
    for text in ("x" * 20_000, "'" * 5000, " " * 9000 + "a", "'s" * 3000, "é1" * 4000, "中" * 7000):
        assert encoder.encode(text, 64) == (encoder.encoding.encode_ordinary(text), text.encode())


def test_windows_stay_small(ranks, monkeypatch):
    encoder, sizes = tree_bpe.TreeEncoder(ranks), []
    leaf = encoder._leaf
    monkeypatch.setattr(encoder, "_leaf", lambda text: sizes.append(len(text)) or leaf(text))
    text = " ".join(f"word{i}, and 'more'" for i in range(5000))
    encoder.encode(text, 512)
    joins = [s for s in sizes if s < 128]
    assert len(joins) > 100 and sum(sizes) < 1.1 * len(text)


def test_query_12_follows_its_contract(spark, ranks):
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = set()
    for row in read(spark, SF, "documents").collect():
        ids = whole.encode_ordinary(row["text"] or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), whole.decode_bytes(ids))]
        wanted.add((row["doc_id"], len(ids), *sha))
    got = QUERIES["op12_tree_bpe"](spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == wanted


def test_alignment_of_random_ends():
    draw = random.Random(3)
    for _ in range(3000):
        last = draw.randint(1, 400)
        share = draw.choice([0.02, 0.3, 0.9])
        a, b = (sorted({last, *(x for x in range(1, last) if draw.random() < p)}) for p in (share, draw.choice([share, 0.5])))
        if draw.random() < 0.4:
            b = sorted(set(a) ^ {x for x in (draw.randint(1, last - 1) for _ in range(2)) if last > 1} | {last}) if last > 1 else a
        ends = sorted(set(a) & set(b))
        ends_a, ends_b = token_alignment.aligned(a, b)
        assert [a[i - 1] for i in ends_a] == ends == [b[j - 1] for j in ends_b]


def test_long_stretches_are_skipped():
    class Counted(list):
        reads = 0

        def __getitem__(self, key):
            Counted.reads += 1
            return super().__getitem__(key)

    a = list(range(2, 200_002, 2))
    b = sorted([*a, 60_001, 120_001])
    ends_a, ends_b = token_alignment.aligned(Counted(a), Counted(b))
    assert len(ends_a) == len(a) and ends_b[-1] == len(b) and Counted.reads < 600


def brute_alignment(rows):
    """Groups, links and counts by sets of ends, encoding each text by itself."""
    a_tok = Tokenizer.from_str(tokenizer_spec("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = {}
    extra = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte:
            alphabet[chr(byte)] = byte
        else:
            alphabet[chr(extra)] = byte
            extra += 1
    out, counts = [], Counter()
    for doc, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        of_a = [bytes(alphabet[c] for c in a_tok.id_to_token(i)) for i in a]
        of_b = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            out.append((doc, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in of_a]).tolist(), np.cumsum([len(x) for x in of_b]).tolist()
        links, groups, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        counts.update(links)
        out.append((doc, len(a), len(b), links, ";".join(groups)))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return Counter(
        (doc, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), text)
        for doc, n_a, n_b, links, text in out
    )


@pytest.fixture(scope="module")
def vocabularies():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    ranks = tree_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tokenizer_spec("byte_bpe_50k.json"), model, ranks


ODD = [(200, "a▁b"), (201, "<|endoftext|><unk></s>"), (202, "  two  spaces "), (203, "\x00\x7f​ éﬁ"), (204, "z" * 3000)]


@pytest.mark.parametrize("fast", [False, True])
def test_alignment(spark, docs, no_docs, vocabularies, fast):
    spec, model, ranks = vocabularies
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    rows = docs.where("doc_id IS NULL OR doc_id != 11").select("doc_id", "text").unionByName(odd)
    wanted = brute_alignment([row for row in texts() if row[0] != 11] + ODD)
    got = token_alignment.align_tokens(rows.selectExpr("*", "1 AS pairs", "2 AS links"), spec, model, ranks if fast else None, groups=True)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert Counter(tuple(r) for r in got.collect()) == wanted
    assert token_alignment.align_tokens(no_docs, spec, model).isEmpty()


def test_query_13_follows_its_contract(spark):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect()]
    wanted = Counter()
    for (*start, text), n in brute_alignment(rows).items():
        wanted[*start, hashlib.sha256(text.encode()).hexdigest() if text else ""] += n
    got = QUERIES["op13_diagonal_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == wanted
