"""Ranked search, removal of repeated bytes and the prefix trie against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_search(docs, items, k):
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    own = [(i, Counter(TERM.findall(fold(t)))) for i, t in docs if t and TERM.search(t)]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    found = []
    for item, text in set(items):
        scored = []
        for doc_id, tf in own:
            m = 75 + 25 * sum(tf.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m)) for t in TERM.findall(fold(text or "")) if t in tf)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


@pytest.mark.parametrize("range_docs, fan, block_bytes", [(1024, 16, 4 << 20), (7, 2, 150), (1, 3, 1)])
def test_ranked_search(spark, range_docs, fan, block_bytes):
    from postloom.llm import ranked_search

    rng = random.Random(1)
    words = ["Ab", "aB", "c", "é", "É", "x_y", "1", "dd", "e-e", "ffff", "straße", "٣", "zz"]
    text = lambda: " ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randint(0, 12)))
    docs = [(rng.choice([i, i, i, i // 2, None]), rng.choice([text(), text(), text(), None, "", " .- ", "c dd"])) for i in range(150)] + [(999, "dd " * 3000)]
    items = [(i, text()) for i in range(12)] + [(3, None), (3, "dd"), (3, "dd"), (None, "zz zz c"), (50, "nowhere"), (51, "")]
    got = ranked_search.search(
        spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, query string, range int").repartition(4), spark.createDataFrame(items, "item_id long, text string"), k=5, range_docs=range_docs, fan=fan, block_bytes=block_bytes
    ).collect()
    assert sorted(map(tuple, got), key=str) == slow_search(docs, items, 5)


def test_ranked_search_opens_few_nodes():
    from postloom.llm import ranked_search as R

    rng = np.random.default_rng(0)
    ends, terms, most = np.arange(1, 1025), rng.integers(0, 3, 1024), np.sort(rng.integers(1, 1000, 1024))
    levels = R.levels_of(ends, terms, most)
    weights = np.array([5, 3, 0])
    best = R.Best(4, 0)
    opened = R.descend(levels, np.arange(1024), weights, int((weights[levels[-1][1]] * levels[-1][2]).sum()), best)
    want = sorted(((int(weights[t] * m), -i) for i, (t, m) in enumerate(zip(terms, most))), reverse=True)[:4]
    assert sorted(best.heap, reverse=True) == want and opened < 40  # of 69


def test_ranked_search_of_empty_tables(spark):
    from postloom.llm import ranked_search

    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.search(docs.where("false"), items).count() == 0 == ranked_search.search(docs, items.where("false")).count()
    assert ranked_search.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def slow_removal(rows, length=50):
    low, texts = {}, [(math.inf if i is None else i, (t or "").encode()) for i, t in rows]
    for i, text in texts:
        for s in range(len(text) - length + 1):
            low[text[s : s + length]] = min(low.get(text[s : s + length], math.inf), i)
    found = []
    for (doc_id, _), (i, text) in zip(rows, texts):
        gone = bytearray(len(text) + 1)
        for s in range(len(text) - length + 1):
            if low[text[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(text, gone) if not g)
        found.append((doc_id, len(text), sum(gone), sum(gone[j] and not (j and gone[j - 1]) for j in range(len(text))), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("alphabet, options", [("abcdefgh é", {}), ("ab", {"hot": 3, "local_hot": 2, "batch_bytes": 900, "shallow": 8, "pool_bytes": 500}), ("abcdefgh é", {"hot": 0, "local_hot": 0, "batch_bytes": 3000}), ("ab", {"shallow": 48})])
def test_repeated_bytes(spark, alphabet, options):
    from postloom.llm import repeated_bytes

    rng = random.Random(5)
    bank = ["".join(rng.choices(alphabet, k=rng.randint(30, 200))) for _ in range(12)] + [" " * 90, "ab" * 60, "abc" * 40]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(bank)[rng.randint(0, 20) :] if rng.random() < 0.6 else "".join(rng.choices(alphabet, k=rng.randint(0, 90))) for _ in range(rng.randint(0, 6)))
        rows.append((rng.choice([None, i, i, i, i // 2]), rng.choice([None, "", text, text, text, text, text, text])))
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, number int, own string").repartition(5)
    got = repeated_bytes.remove_repeats(docs, **options).collect()
    assert sorted(map(tuple, got), key=str) == slow_removal(rows)
    assert repeated_bytes.remove_repeats(docs.where("false")).count() == 0


def test_repeats_across_pieces(spark):
    from postloom.llm import repeated_bytes

    rng = random.Random(6)
    long = bytes(rng.choices(range(97, 123), k=repeated_bytes.PIECE * 2 + 70)).decode()
    rows = [(2, long), (1, long[repeated_bytes.PIECE - 60 : repeated_bytes.PIECE + 60]), (3, long[-55:] + "x"), (4, "y" * 49)]
    got = {r.doc_id: r for r in repeated_bytes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[2].n_removed, got[2].n_spans) == (120, 1) and (got[1].n_removed, got[4].n_removed) == (0, 0) and got[3].n_removed == 55
    assert got[3].kept_sha256 == hashlib.sha256(b"x").hexdigest()


def test_deep_shallow_orders_suffixes():
    from postloom.llm.repeated_bytes import deep_shallow

    rng = random.Random(9)
    text = bytes(rng.choices(b"ab", k=400)) + b"ab" * 100 + bytes(rng.choices(b"\x00\xffz", k=300))
    for shallow in (0, 8, 24, 48):
        starts = np.arange(len(text) - 50 + 1)
        order, run = deep_shallow(text, starts, 50, shallow)
        strings = [text[s : s + 50] for s in starts[order]]
        assert strings == sorted(strings) and sorted(order) == list(range(len(starts)))
        assert [a == b for a, b in zip(strings, strings[1:])] == [a == b for a, b in zip(run, run[1:])]


def slow_trie(rows, every=100):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, key, (role or "", text or "")))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % every, [])[:h] + turns[h:] if every else turns
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = lambda n: not any(len(x) == len(n) + 1 and x[: len(n)] == n for x in members)
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        saved = sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below)
        found.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(x) == len(node) + 1 for x in below), sum(map(childless, below)), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("local", [0, 12, 20_000])
def test_prefix_trie(spark, local):
    from postloom.llm import prefix_trie

    rng = random.Random(3)
    rows = []
    for c in [*range(0, 14), *range(100, 112), 250, 307, 1200]:
        for turn in range(rng.choice([1, 2, 3, 7])):
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "user", None]), rng.choice(["a", "a", "hé", None, ""])))
    rows += [(None, 1, "user", "x"), (5, 1, "user", "a"), (5, 1, "user", "a"), (401, 0, "user", "b" * 5000), *[(402, t, "user", "same") for t in range(20)], *[(403, t, "user", "same") for t in range(20)]]
    talks = spark.createDataFrame([(*r, "c", 2) for r in rows], "conv_id long, turn long, role string, text string, cls string, place int").repartition(3)
    got = prefix_trie.conversation_trie(talks, 100, local).collect()
    assert sorted(map(tuple, got), key=str) == slow_trie(rows)
    if local == 12:
        plain = prefix_trie.conversation_trie(talks, None, local).collect()
        assert sorted(map(tuple, plain), key=str) == slow_trie(rows, 0)
        assert prefix_trie.conversation_trie(talks.where("false"), 100).count() == 0


def test_ids_that_end_at_one_node_are_hashed_in_pieces(spark, monkeypatch):
    from postloom.llm import prefix_trie

    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    talks = spark.createDataFrame([(c, 0, "user", "the same") for c in range(500)], "conv_id long, turn long, role string, text string")
    got = {r.depth: r for r in prefix_trie.conversation_trie(talks, None, 0).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest() and got[1].n_convs == 500


def test_shards_against_brute_force(spark):
    """Bounds, slots and sizes of every row: shards are ranges of the text's hash, slots follow it."""
    import xxhash

    from postloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    key = {i: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64(t.encode(), seed=42).intdigest()) for i, t in rows}
    got = {r.doc_id: r for r in QUERIES["op4_sharding"](spark, folder).collect()}
    shards = {}
    for i, t in rows:
        assert (got[i].size, got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(t.encode()) + 8, zlib.crc32(t.encode()), "bytes", None)
        shards.setdefault(got[i].shard, []).append((key[i], i))
    order = sorted(shards)
    assert all(max(shards[a])[0] < min(shards[b])[0] for a, b in zip(order, order[1:])) and set(order) <= set(range(24))
    for own in shards.values():
        assert [got[i].slot for _, i in sorted(own)] == list(range(len(own)))
    # each bound lies where the bytes below it come nearest its share, but for a group of equal texts
    total, below = sum(r.size for r in got.values()), 0
    groups = Counter()
    for i, t in rows:
        groups[t] += got[i].size
    for s in range(23):
        below += sum(got[i].size for _, i in shards.get(s, []))
        assert abs(below - total * (s + 1) / 24) <= max(groups.values()) + 0.001 * total


def test_targets_of_a_mix_against_brute_force(spark):
    from postloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    of = {r.doc_id: r.source for r in rows}
    sources = sorted({s for s in of.values() if s is not None}) + ([None] if None in of.values() else [])
    whole = {s: sum(size[i] for i in size if of[i] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, total = {}, sum(whole.values())
    while True:  # the excess of those at their limit goes to the others
        free = [s for s in sources if s not in target]
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * whole[s]]
        if not over:
            target |= share
            break
        target |= {s: 3.0 * whole[s] for s in over}
    got = QUERIES["op8_mixing"](spark, folder).collect()
    taken = Counter()
    for r in got:
        s = of[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == whole[s] and abs(r.target - target[s]) < 1e-6 * total and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= max(0.01 * target[s], min(size[i] for i in size if of[i] == s and size[i])) for s in sources), [(s, taken[s], target[s]) for s in sources]
