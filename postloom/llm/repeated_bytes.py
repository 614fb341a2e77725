"""Suffix-array dedup: bytes covered by a string of `length` bytes that a document with a smaller doc_id also has go.

1. Every window of `length` bytes names its anchor, the gram of GRAM bytes in it with the smallest hash (the last of
   equal ones). Equal windows name equal grams at equal places, so that only windows around one gram need meet.
   Consecutive windows with one anchor form a segment; about every sixteenth byte is an anchor.
2. Segments are counted by gram and by a fingerprint of all their bytes. Of equal segments in a batch of documents that of the
   smallest doc_id is shipped, the others are covered. Grams that one document has are dropped. Where a gram comes with
   one fingerprint (64 bits besides the gram's 64), the smallest doc_id covers the others at once.
3. The other segments meet by gram, with their bytes. A gram with more than HOT of them, or LOCAL_HOT different ones in a
   batch, is split: its windows meet by a hash of their own, so that no gram's contexts fill a task.
4. A task's segments form a pool of text whose suffix array is sorted deep-shallow: multikey quicksort on eight-byte characters
   to SHALLOW bytes, then a blind trie for each group of suffixes that are still equal, to `length` bytes. Suffixes
   with that many bytes in common are equal windows, which the smallest doc_id among them covers.
5. The spans found go back to their documents, are united, and cut from the text.

No pair of documents is ever formed. A task holds a batch of at most BATCH bytes of text (a longer document is cut into
overlapping pieces), a partition's anchors of PARTITION bytes of text, or the segments of one gram.

Defined cases: a null text is empty, and texts shorter than `length` bytes stay whole. Rows that share a doc_id don't cover each
other. A null doc_id counts as larger than all others. Other columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, give_back_memory, release_shuffles, small_batches, whole_text

LENGTH, GRAM = 50, 20
#: Bytes of text in a batch, in a piece that is hashed at once, and behind each partition of anchors.
BATCH, PIECE, PARTITION = 8 << 20, 1 << 19, 64 << 20
#: Segments of a gram, in all and different ones in a batch, beyond which its windows are dealt one by one.
HOT, LOCAL_HOT = 4096, 64
#: Bytes to which multikey quicksort goes, and of text whose suffixes are sorted together.
SHALLOW, POOL = 32, 8 << 20
#: Stands for a null doc_id.
LAST = np.iinfo(np.int64).max

_MULT, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_BLOB = pa.schema([("target", pa.int32()), ("kind", pa.int32()), ("base", pa.int64()), ("blob", pa.binary())])
_KEPT = pa.schema([("number", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("gram", pa.int64()), ("hot", pa.bool_())])
_ENTRY = pa.schema([("key", pa.int64()), ("seg", pa.binary()), ("doc", pa.int64()), ("places", pa.binary())])
_SPAN = pa.schema([("number", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])
_DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _record(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


class Anchors:
    """Segments of texts: each anchor's gram, and the run of windows that name it."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(PIECE + 4 * length, _MULT, np.uint64)])
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(PIECE + 4 * length, pow(_MULT, -1, 1 << 64), np.uint64)])

    def of_piece(self, buf: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """gram, fingerprint, first window and number of windows of each segment among the windows that start at valid places."""
        k, wide = self.gram, self.length - self.gram + 1
        with np.errstate(over="ignore"):
            sums = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(buf * self.powers[: len(buf)], out=sums[1:])
            h = (sums[k:] - sums[:-k]) * self.inverse[: len(buf) - k + 1]
            h ^= h >> np.uint64(31)
            h *= np.uint64(_MIX)
            h ^= h >> np.uint64(29)
        low = (1 << 24) - 1
        least = (h & np.uint64(~low & (1 << 64) - 1)) | (np.uint64(low) - np.arange(len(h), dtype=np.uint64))
        have = 1
        while have * 2 <= wide:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < wide:
            least = np.minimum(least[: len(least) - (wide - have)], least[wide - have :])
        named = least[valid]
        first = np.flatnonzero(np.r_[True, (named[1:] != named[:-1]) | (valid[1:] != valid[:-1] + 1)])
        place = low - (named[first] & np.uint64(low)).astype(np.int64)
        at, n = valid[first], np.diff(np.r_[first, len(valid)])
        with np.errstate(over="ignore"):
            whole = (sums[at + n + self.length - 1] - sums[at]) * self.inverse[at]
            whole ^= whole >> np.uint64(33)
            whole *= np.uint64(_MULT)
            whole ^= n.astype(np.uint64)
        return h[place].view(np.int64), whole.view(np.int64), at, n

    def of(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """Number of the text, gram, fingerprint, first window (in its text) and windows of all segments, piece by piece."""
        todo, size = [], 0
        for i, text in enumerate(texts):
            # windows that start in [s, s + PIECE) need the bytes up to s + PIECE + length - 1
            for s in range(0, max(0, len(text) - self.length + 1), PIECE):
                part = text[s : s + PIECE + self.length - 1]
                if size + len(part) > PIECE + self.length and todo:
                    yield self._joined(todo)
                    todo, size = [], 0
                todo.append((i, s, part))
                size += len(part)
        if todo:
            yield self._joined(todo)

    def _joined(self, parts: list[tuple]) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(p) for _, _, p in parts])
        starts = np.cumsum(sizes) - sizes
        windows = sizes - self.length + 1
        of = np.repeat(np.arange(len(parts)), windows)
        valid = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + starts[of]
        gram, whole, first, n = self.of_piece(np.frombuffer(b"".join(p for _, _, p in parts), np.uint8), valid)
        part = np.searchsorted(starts, first, "right") - 1
        number, shift = np.array([i for i, _, _ in parts]), np.array([s for _, s, _ in parts])
        return number[part], gram, whole, first - starts[part] + shift[part], n


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, byte planes apart and compressed."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    raw, wide = zstandard.ZstdDecompressor().decompress(blob), [np.dtype(t).itemsize for t in types]
    n, at, found = len(raw) // sum(wide), 0, []
    for t, w in zip(types, wide):
        found.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n).T).view(t).reshape(n))
        at += n * w
    return found


#: Of the three kinds of rows: what is counted, spans that are decided, and segments of grams that are hot in their batch.
_TYPES = (("<i8", "<i8", "<u4", "<i8", "<u4", "u1", "u1"), ("<u4", "<u4", "<u4"), ("<i8", "<u4", "<u4", "u1"))


def _count(targets: int, batch_bytes: int, length: int, local_hot: int):
    """Batches of texts to rows for the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        anchors, me = Anchors(length), TaskContext.get().partitionId()
        numbers, docs, texts, size = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            base = min(numbers)
            of, gram, print_, first, n = (np.concatenate(x) for x in zip(*anchors.of(texts)))
            order = np.lexsort((print_, gram))
            of, gram, print_, first, n = (x[order] for x in (of, gram, print_, first, n))
            idx, doc, first, n = (np.array(numbers, np.int64) - base)[of].astype(np.uint32), np.array(docs, np.int64)[of], first.astype(np.uint32), n.astype(np.uint8)
            new_gram = np.r_[True, gram[1:] != gram[:-1]]
            new_print = new_gram | np.r_[True, print_[1:] != print_[:-1]]
            start = np.flatnonzero(new_print)
            covered = doc > np.repeat(np.minimum.reduceat(doc, start), np.diff(np.r_[start, len(doc)]))
            grams = np.flatnonzero(new_gram)
            many = np.repeat(np.add.reduceat(new_print.astype(np.int64), grams) > local_hot, np.diff(np.r_[grams, len(gram)]))
            # spans of a text come in order and so do their ends: those that touch are one
            own = np.flatnonzero(covered)
            own = own[np.lexsort((first[own], idx[own]))]
            if len(own):
                end = first[own] + n[own] + np.uint32(length - 1)
                run = np.flatnonzero(np.r_[True, (idx[own][1:] != idx[own][:-1]) | (first[own][1:] > end[:-1])])
                last = np.r_[run[1:], len(own)] - 1
                yield _record([[me % targets], [1], [base], [_pack(idx[own][run], first[own][run], end[last] - first[own][run])]], _BLOB)
            # of a gram that is hot here one segment is counted, and says so
            left = np.flatnonzero(~covered)
            told = many[left] & np.r_[True, gram[left][1:] != gram[left][:-1]]
            past = left[many[left] & ~told]
            if len(past):
                yield _record([[me % targets], [2], [base], [_pack(gram[past], idx[past], first[past], n[past])]], _BLOB)
            left, told = left[told | ~many[left]], told[told | ~many[left]].astype(np.uint8)
            # anchors have small hashes, as the smallest of many: mixed again, all targets get as many
            with np.errstate(over="ignore"):
                target = ((gram[left].view(np.uint64) * np.uint64(_MULT) >> np.uint64(32)) * np.uint64(targets) >> np.uint64(32)).astype(np.int32)
            order = np.lexsort((idx[left], target))
            left, told, cuts = left[order], told[order], np.searchsorted(target[order], np.arange(targets + 1))
            for t in range(targets):
                if cuts[t] < cuts[t + 1]:
                    own = left[cuts[t] : cuts[t + 1]]
                    yield _record([[t], [0], [base], [_pack(gram[own], print_[own], idx[own], doc[own], first[own], n[own], told[cuts[t] : cuts[t + 1]])]], _BLOB)

        for batch in batches:
            for number, doc, text in zip(*(batch.column(k).to_pylist() for k in ("number", "doc", "text"))):
                if numbers and (size + len(text) > batch_bytes or abs(number - numbers[0]) >= 1 << 31):
                    yield from flush()
                    numbers, docs, texts, size = [], [], [], 0
                numbers.append(number)
                docs.append(doc)
                texts.append(text)
                size += len(text) + 100
        if numbers:
            yield from flush()
        anchors = numbers = docs = texts = None
        give_back_memory()

    return run


def _keep(hot: int, length: int):
    """The segments of one target's grams: spans (without a gram) where a gram has one segment, else those that meet others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = []
        for batch in batches:
            for kind, base, blob in zip(*(batch.column(k).to_pylist() for k in ("kind", "base", "blob"))):
                found = _unpack(blob, *_TYPES[kind])
                if kind == 0:
                    own.append((found[0], found[1], found[2].astype(np.int64) + base, *found[3:]))
                elif kind == 1:
                    yield _record([found[0].astype(np.int64) + base, found[1].astype(np.int64), found[2].astype(np.int32), pa.nulls(len(found[0]), pa.int64()), np.zeros(len(found[0]), bool)], _KEPT)
                else:
                    yield _record([found[1].astype(np.int64) + base, found[2].astype(np.int64), found[3].astype(np.int32), found[0], np.ones(len(found[0]), bool)], _KEPT)
        if own:
            gram, print_, number, doc, first, n, told = (np.concatenate(x) for x in zip(*own))
            own = None
            order = np.lexsort((print_, gram))
            gram, print_, number, doc, first, n, told = (x[order] for x in (gram, print_, number, doc, first, n, told))
            new = np.r_[True, gram[1:] != gram[:-1]]
            start = np.flatnonzero(new)
            size = np.diff(np.r_[start, len(gram)])
            least = np.minimum.reduceat(doc, start)
            prints = np.add.reduceat((new | np.r_[True, print_[1:] != print_[:-1]]).astype(np.int64), start)
            said = np.maximum.reduceat(told, start) > 0
            one = (prints == 1) & ~said
            at = np.flatnonzero(np.repeat(one, size) & (doc > np.repeat(least, size)))
            for s in range(0, len(at), 50_000):
                x = at[s : s + 50_000]
                yield _record([number[x], first[x].astype(np.int64), n[x].astype(np.int32) + (length - 1), pa.nulls(len(x), pa.int64()), np.zeros(len(x), bool)], _KEPT)
            many = np.repeat(said | (size > hot), size)
            at = np.flatnonzero(np.repeat(~one & (said | (np.maximum.reduceat(doc, start) > least)), size))
            for s in range(0, len(at), 50_000):
                x = at[s : s + 50_000]
                yield _record([number[x], first[x].astype(np.int64), n[x].astype(np.int32), gram[x], many[x]], _KEPT)
            gram = print_ = number = doc = first = n = told = new = order = many = at = None
        give_back_memory()

    return run


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of spans, which may overlap or touch."""
    done: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if done and first <= done[-1][1]:
            if end > done[-1][1]:
                done[-1] = (done[-1][0], end)
        else:
            done.append((first, end))
    return done


def _segments(batch_bytes: int, length: int):
    """Documents with their anchors to segments that meet others; spans that the batch decides itself have no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # segment: its key, smallest doc_id, and that one's places
        held: dict[bytes, list] = {}
        parts: dict[bytes, list] = {}
        spans: dict[int, list] = {}
        size = 0

        def add(table: dict, seg: bytes, key: int, doc: int, places: list) -> None:
            entry = table.get(seg)
            if entry is None:
                table[seg] = [key, doc, places]
            elif doc == entry[1]:
                entry[2] += places
            else:
                covered = places
                if doc < entry[1]:
                    covered, entry[1:] = entry[2], [doc, places]
                for number, at in covered:
                    spans.setdefault(number, []).append((at, at + len(seg)))

        def flush() -> Iterator[pa.RecordBatch]:
            for seg in [s for s, e in held.items() if e[0] is None]:  # hot: window by window
                _, doc, places = held.pop(seg)
                for i in range(len(seg) - length + 1):
                    window = seg[i : i + length]
                    add(parts, window, int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True), doc, [(number, at + i) for number, at in places])
            for table in (held, parts):
                rows = [(key, seg, doc, np.array(places, "<i8").tobytes()) for seg, (key, doc, places) in table.items()]
                for s in range(0, len(rows), 5000):
                    yield _record(zip(*rows[s : s + 5000]), _ENTRY)
            rows = [(number, None, first, end.to_bytes(8, "little")) for number, own in spans.items() for first, end in united(own)]
            for s in range(0, len(rows), 5000):
                yield _record(zip(*rows[s : s + 5000]), _ENTRY)

        for batch in batches:
            for number, doc, text, own in zip(*(batch.column(k).to_pylist() for k in ("number", "doc", "text", "own"))):
                if size + len(text) > batch_bytes and size:
                    yield from flush()
                    held, parts, spans, size = {}, {}, {}, 0
                size += len(text) + 100
                for x in own:
                    at = x["at"]
                    add(held, text[at : at + x["n"] + length - 1], None if x["hot"] else x["gram"], doc, [(number, at)])
        yield from flush()
        held, parts, spans = {}, {}, {}
        give_back_memory()

    return run


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """The strings' order: lists of the equal ones' numbers, rising. All have one length, and none ends inside a branch.

    A node is [depth, children by byte]; a leaf is the list of its strings' numbers. To insert, a blind walk
    finds some leaf, the first byte that differs from that leaf's string tells where to branch.
    """
    root: list | None = None
    for i, s in enumerate(strings):
        if root is None:
            root = [i]
            continue
        node = root
        while type(node) is tuple:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = strings[node[0]]
        if s == other:
            node.append(i)
            continue
        lcp = 0
        while s[lcp] == other[lcp]:
            lcp += 1
        up, node = None, root
        while type(node) is tuple and node[0] < lcp:
            up, node = node, node[1][s[node[0]]]
        if type(node) is tuple and node[0] == lcp:
            node[1][s[lcp]] = [i]
            continue
        branch = (lcp, {other[lcp]: node, s[lcp]: [i]})
        if up is None:
            root = branch
        else:
            up[1][s[up[0]]] = branch
    done, todo = [], [root]
    while todo:
        node = todo.pop()
        if type(node) is tuple:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            done.append(node)
    return done


def deep_shallow(text: bytes, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of text at starts, ordered by their first `length` bytes: the order, and for each place in it the number of its run of equal ones."""
    raw = np.frombuffer(text + bytes(8), np.uint8)
    order, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    shallow = min(shallow, length) // 8 * 8
    for depth in range(0, shallow, 8):
        # groups of one are done; the others split by the next eight bytes, all groups at once
        size = np.bincount(group)
        todo = np.flatnonzero(size[group] > 1)
        at = starts[order[todo]] + depth
        word = np.zeros(len(todo), np.uint64)
        for i in range(8):
            word = word << np.uint64(8) | raw[at + i]
        by = np.lexsort((word, group[todo]))
        order[todo], word = order[todo][by], word[by]
        new = np.zeros(len(order), np.int64)
        new[1:] = group[1:] != group[:-1]
        new[todo[1:]] |= (word[1:] != word[:-1]) & (todo[1:] == todo[:-1] + 1)
        group = np.cumsum(new)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
    size = np.diff(np.r_[first, len(group)])
    new = np.zeros(len(order), np.int64)
    new[first[1:]] = 1
    for f, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
        own = order[f : f + n].copy()
        at = f
        for leaf in blind_trie([text[s + shallow : s + length] for s in starts[own].tolist()]):
            if at > f:
                new[at] = 1
            order[at : at + len(leaf)] = own[leaf]
            at += len(leaf)
    return order, np.cumsum(new)


def _decide(length: int, shallow: int, pool_bytes: int):
    """Segments sorted by key and doc_id: the spans whose windows a smaller doc_id has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: list[tuple] = []
        done: list[tuple] = []
        pool: list[tuple] = []
        group: list[tuple] = []
        size, at = 0, None

        def places_of(packed: bytes) -> list[list[int]]:
            return np.frombuffer(packed, "<i8").reshape(-1, 2).tolist()

        def close() -> None:
            nonlocal size
            if not group:
                return
            seg, least = group[0][0], group[0][1]
            if all(x[0] == seg for x in group):
                for _, doc, packed in group:
                    if doc > least:
                        spans.extend((number, first, first + len(seg)) for number, first in places_of(packed))
            else:
                pool.extend(group)
                size += sum(len(x[0]) for x in group)

        def sort_pool() -> None:
            if not pool:
                return
            different: dict[bytes, int] = {}
            of = np.array([different.setdefault(seg, len(different)) for seg, _, _ in pool])
            docs = np.array([doc for _, doc, _ in pool], np.int64)
            least = np.full(len(different), LAST, np.int64)
            np.minimum.at(least, of, docs)
            sizes = np.array([len(s) for s in different])
            begin, windows = np.cumsum(sizes) - sizes, sizes - length + 1
            seg_of = np.repeat(np.arange(len(sizes)), windows)
            start = np.arange(len(seg_of)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[seg_of]
            order, run_of = deep_shallow(b"".join(different), start, length, shallow)
            smallest = np.full(run_of[-1] + 1, LAST, np.int64)
            np.minimum.at(smallest, run_of, least[seg_of[order]])
            have = np.empty(len(order), np.int64)
            have[order] = smallest[run_of]  # the smallest doc_id that has the window
            # each entry's windows that a smaller doc_id has, and their runs
            own = windows[of]
            entry = np.repeat(np.arange(len(of)), own)
            at_ = np.arange(len(entry)) - np.repeat(np.cumsum(own) - own, own)
            found = np.flatnonzero(have[(np.cumsum(windows) - windows)[of][entry] + at_] < docs[entry])
            if not len(found):
                return
            entry, at_ = entry[found], at_[found]
            run = np.flatnonzero(np.r_[True, (entry[1:] != entry[:-1]) | (np.diff(at_) > length)])
            last = np.r_[run[1:], len(entry)] - 1
            places = np.frombuffer(b"".join(packed for _, _, packed in pool), "<i8").reshape(-1, 2)
            many = np.array([len(packed) // 16 for _, _, packed in pool])
            of_run = many[entry[run]]
            each = np.repeat(np.arange(len(run)), of_run)
            place = (np.cumsum(many) - many)[entry[run]][each] + np.arange(len(each)) - np.repeat(np.cumsum(of_run) - of_run, of_run)
            done.append((places[place, 0], places[place, 1] + at_[run][each], places[place, 1] + at_[last][each] + length))

        def flush() -> Iterator[pa.RecordBatch]:
            for s in range(0, len(spans), 20_000):
                yield _record(zip(*spans[s : s + 20_000]), _SPAN)
            spans.clear()
            for columns in done:
                for s in range(0, len(columns[0]), 50_000):
                    yield _record([c[s : s + 50_000] for c in columns], _SPAN)
            done.clear()

        for batch in batches:
            for key, seg, doc, packed in zip(*(batch.column(k).to_pylist() for k in ("key", "seg", "doc", "places"))):
                if seg is None:  # decided before
                    spans.append((key, doc, int.from_bytes(packed, "little")))
                    continue
                if key != at:
                    close()
                    at, group = key, []
                    if size > pool_bytes:
                        sort_pool()
                        pool, size = [], 0
                group.append((seg, doc, packed))
            if len(spans) > 100_000 or done:
                yield from flush()
        close()
        sort_pool()
        yield from flush()
        pool = group = []
        give_back_memory()

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, own in zip(*(batch.column(k).to_pylist() for k in ("doc", "text", "own"))):
            runs = united([(x["first"], x["end"]) for x in own or ()])
            sha, at = hashlib.sha256(), 0
            for first, end in runs:
                sha.update(text[at:first])
                at = end
            sha.update(text[at:])
            rows.append((None if doc == LAST else doc, len(text), sum(e - f for f, e in runs), len(runs), sha.hexdigest()))
        yield _record(zip(*rows) if rows else [[]] * len(_DONE), _DONE)
    give_back_memory()


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, local_hot: int = LOCAL_HOT, batch_bytes: int = BATCH, shallow: int = SHALLOW, pool_bytes: int = POOL) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the digest of what is left."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeated-bytes")
    text = F.encode(whole_text(text_col), "UTF-8")
    texts = docs.select(F.monotonically_increasing_id().alias("number"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), text.alias("text"))
    with small_batches(spark, rows=256):
        texts = scratch.table(texts, "texts", compression="zstd")
        total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION))

        long = texts.where(F.octet_length("text") >= length)
        blobs = long.mapInArrow(_count(parts, batch_bytes, length, local_hot), "target int, kind int, base long, blob binary")
        kept = scratch.table(blobs.repartitionById(parts, F.col("target")).mapInArrow(_keep(hot, length), "number long, at long, n int, gram long, hot boolean"), "kept", compression="zstd")
        release_shuffles(spark)

        anchors = kept.where("gram is not null").groupBy("number").agg(F.collect_list(F.struct("gram", "at", "n", "hot")).alias("own"))
        entries = texts.join(anchors, "number").select("number", "doc", "text", "own").mapInArrow(_segments(batch_bytes, length), "key long, seg binary, doc long, places binary")
        met = entries.repartition(parts, "key").sortWithinPartitions("key", "doc")
        spans = scratch.table(met.mapInArrow(_decide(length, shallow, pool_bytes), "number long, first long, end long"), "spans", compression="zstd")
        release_shuffles(spark)

        spans = spans.unionByName(kept.where("gram is null").select("number", F.col("at").alias("first"), (F.col("at") + F.col("n")).alias("end")))
        runs = spans.groupBy("number").agg(F.collect_list(F.struct("first", "end")).alias("own"))
        cut = texts.join(runs, "number", "left").select("doc", "text", "own").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        done = scratch.table(cut, "cut")
    release_shuffles(spark)
    for label in ("texts", "kept", "spans"):
        scratch.drop(label)
    return done


def op12_repeated_bytes(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as (select r, doc_id, i, substring(x, 2 * i + 1, 100) as s from (select r, doc_id, x, unnest(range(length(x) // 2 - 49)) as i from d where length(x) >= 100)),
f as (select s, min(doc_id) as low from w group by s),
hit as (select r, i from w join f using (s) where low < doc_id or doc_id is null and low is not null),
cut as (select r, i, coalesce(i - lag(i) over (partition by r order by i) > 50, true) as new from hit),
num as (select r, i, sum(cast(new as int)) over (partition by r order by i) as k from cut),
runs as (select r, k, min(i) as a, max(i) + 50 as b from num group by r, k),
parts as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as before from runs),
gone as (select r, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last, string_agg(substring(x, 2 * before + 1, 2 * (a - before)), '' order by a) as front from parts join d using (r) group by r)
select doc_id, length(x) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(front, '') || substring(x, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join gone using (r)"""
