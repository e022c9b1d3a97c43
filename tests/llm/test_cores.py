"""The parts that run inside tasks, against plain versions; no Spark."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from touchline.llm import exact_dedup, jaccard_join, license_scan, line_dedup, order_minhash, packing, pieces, shards, shingles, token_blocks, toxicity
from touchline.llm.components import Forest
from touchline.llm.tokens import CachedTokenizer, drop_spaces, lead_spaces


@pytest.mark.parametrize("name, cut", [("word_bpe_49k.json", drop_spaces), ("byte_bpe_50k.json", lead_spaces)])
def test_cached_tokenizer_equals_the_library(name, cut):
    path, r = public_tokenizers.path(name), random.Random(1)
    library, cached = Tokenizer.from_file(path), CachedTokenizer(path, cut, limit=500)
    signs = [" ", " ", "a", "The", "\n", "\t", "'s", "1", "é", "́", " ", "\x1c", "!", "ſ", "中", ".,", "<|endoftext|>", "ΑΣ"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    for text in texts:
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert cached.ids(text) == want, ascii(text)
    assert cached.ids(None) == b""


@pytest.mark.parametrize("ids", [[], [0], [5] * 128, [2**32 - 1, 0, 7], list(range(1000)), [1] * 300 + [4_000_000_000] * 3 + [2] * 70])
def test_blocks_come_back(ids):
    data = token_blocks.encode_segment(np.array(ids, np.uint32))
    assert token_blocks.decode_segment(data).tolist() == ids
    assert token_blocks.decode_segment(data, 100, 60).tolist() == ids[100:160]


def test_a_few_large_ids_do_not_widen_a_block():
    ids = np.tile(np.arange(128, dtype=np.uint32) % 8, 10)
    ids[::128] = 60_000
    assert len(token_blocks.encode_segment(ids)) < 10 * (4 * 4 * 3 + 8 + 16) + 64


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        token_blocks.decode_segment(b"\0" * 32)


@pytest.mark.parametrize("bits", [64, 40])
def test_quotient_filters_merge_without_loss(bits):
    r = np.random.default_rng(0)
    values = r.integers(0, 2**bits - 1, 500, dtype=np.uint64)
    values = np.concatenate([values, values[:200], values[:3], values[:3]])
    parts = [exact_dedup.QuotientFilter.from_bytes(exact_dedup.QuotientFilter.build(p, bits=bits).to_bytes()) for p in np.array_split(values, 4)]
    merged = parts[0].merge(*parts[1:], exact_dedup.QuotientFilter.build(np.empty(0, np.uint64), bits=bits))
    want, counts = np.unique(values, return_counts=True)
    assert (merged.fingerprints() == want).all() and (merged.count == counts).all()


def _plain_fingerprint(hashes, numbered):
    """Components from the two smallest numbered hashes of each of the 64 bins, in the order of the text."""
    want = []
    for b in range(64):
        here = np.flatnonzero(numbered >> np.uint64(58) == b)
        total = np.array([order_minhash._ODD], np.uint64)
        for i in sorted(here[np.argsort(numbered[here], kind="stable")[:2]].tolist()):
            total = order_minhash.mix64(total * np.uint64(31) + hashes[i : i + 1])
        want.append(max(1, int(total[0] >> np.uint64(32))) if len(here) else 0)
    return want


def test_order_minhash_numbers_whole_hashes(monkeypatch):
    r = np.random.default_rng(3)
    # a text of more than 2**24 k-mers, all different
    points = r.integers(0x4E00, 0x9000, (1 << 24) + 100).astype("<u4")
    hashes = order_minhash._kmer_hashes(points, order_minhash.K)
    with np.errstate(over="ignore"):
        assert order_minhash.fingerprint(points.tobytes().decode("utf-32-le")).tolist() == _plain_fingerprint(hashes, order_minhash.mix64(hashes))
        # hashes that differ in their last bits only
        alike = (r.integers(0, 50, 400).astype(np.uint64) << np.uint64(40)) | r.integers(0, 5, 400).astype(np.uint64)
        seen, nth = {}, []
        for h in alike.tolist():
            nth.append(seen.get(h, 0))
            seen[h] = nth[-1] + 1
        monkeypatch.setattr(order_minhash, "_kmer_hashes", lambda points, k: alike)
        numbered = order_minhash.mix64(alike + np.array(nth, np.uint64) * np.uint64(order_minhash._ODD))
        assert order_minhash.fingerprint("any").tolist() == _plain_fingerprint(alike, numbered)


def test_order_minhash():
    a = " ".join(f"word{i}" for i in range(400))
    half = len(a) // 2
    own = order_minhash.fingerprint(a)
    assert order_minhash.likeness(own, order_minhash.fingerprint(a)) == 1
    moved = order_minhash.likeness(own, order_minhash.fingerprint(a[half:] + a[:half]))
    slight = order_minhash.likeness(own, order_minhash.fingerprint(a.replace("word17 ", "")))
    assert moved < 0.7 < slight  # the k-mers are nearly the same, their order is not
    none = order_minhash.fingerprint("")
    assert not none.any() and order_minhash.likeness(none, none) == 1 and order_minhash.likeness(none, own) == 0
    assert (order_minhash.fingerprint("ab") != 0).sum() == 1
    assert order_minhash.likeness(order_minhash.fingerprint("ab" * 40), order_minhash.fingerprint("ab" * 41)) < 1
    assert order_minhash.edited("abcde", "xyz") == "abcxy" and order_minhash.edited("abcd", "x") == "abx" and order_minhash.edited("", "x") == ""


def test_edit_distance_keys_and_counts():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    r = random.Random(3)
    for _ in range(6000):
        a = "".join(r.choice("abé") for _ in range(r.randint(0, 14)))
        b = list(a)
        for _ in range(r.randint(0, 4)):
            at, kind = r.randint(0, len(b)), r.randint(0, 2)
            b[at : at + (kind > 0)] = [] if kind == 1 else [r.choice("abé")]
        b, limit = "".join(b), r.randint(1, 3)
        true = distance(a, b)
        assert line_dedup.edit_distance_within(a, b, limit) == min(true, limit + 1)
        if a != b and true <= limit and min(len(a), len(b)) >= 6:
            x, y = (line_dedup._keys(t, limit) for t in (a, b))
            assert set(x[0]) & set(y[0] + y[1]) or set(y[0]) & set(x[1]), (a, b)
            counters = [np.array([line_dedup._letter_counts(t)], np.int64).view(np.uint64) for t in (a, b)]
            assert len(line_dedup._close_counts(*counters, limit)[0])


def test_viterbi_against_all_paths():
    model, r = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model")), random.Random(2)
    score = {model.pieces[v[1]]: (v[1], v[2]) for v in model.automaton.values()}
    for _ in range(500):
        text = "".join(r.choice([" ", "  ", "a", "the", "Ünï", "中", "😀", "\n", "x", "ing"]) for _ in range(r.randint(0, 20)))
        normal = model.normalize(text)
        best = [(0.0, 0, 0)]
        for end in range(1, len(normal) + 1):
            found = [(best[s][0] + score[normal[s:end]][1], -s, score[normal[s:end]][0]) for s in range(end) if normal[s:end] in score]
            if normal[end - 1] not in model.letters:
                found.append((best[end - 1][0] + model.unknown_score, 1 - end, -1))
            best.append(max(found, key=lambda f: f[:2]))
        ids, at = [], len(normal)
        while at:
            _, start, i = best[at]
            ids += [i] if i >= 0 else [model.bytes_of[b] for b in reversed(normal[at - 1].encode())]
            at = -start
        data, total = model.encode(text)
        assert list(memoryview(data).cast("I")) == ids[::-1] and total == best[-1][0]
        assert model.decode(data) == text
    assert model.encode(None) == (b"", 0)


def test_packing_plan_uses_every_piece_once():
    r = np.random.default_rng(1)
    for n in (0, 1, 7, 3000):
        lengths = r.integers(1, 1025, n)
        counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
        plan, used = packing.pack_histogram(counts, 1024), {}
        for pattern, times in plan:
            assert sum(pattern) <= 1024
            for k in pattern:
                used[k] = used.get(k, 0) + times
        assert used == counts
    windows = sum(t for _, t in plan)
    assert lengths.sum() / (1024 * windows) > 0.97


def test_least_squares_is_exact_where_it_can_be():
    uses = np.array([[1.0, 0, 1], [0, 2, 1]])
    found = packing.least_squares(uses, np.array([30.0, 50]), rounds=5000)
    assert (found >= 0).all() and np.allclose(uses @ found, [30, 50], atol=0.1)


def test_family_links_connect_what_brute_force_connects():
    r = np.random.default_rng(5)
    for case in range(20):
        sets = []
        for _ in range(8):
            base = r.integers(0, 2**63, r.integers(1, 40), dtype=np.uint64)
            for _ in range(r.integers(1, 8)):
                kept = base[r.random(len(base)) < 0.9]
                extra = r.integers(0, 2**63, r.integers(0, 3), dtype=np.uint64)
                if len(kept) + len(extra):
                    sets.append(np.unique(np.concatenate([kept, extra])))
        want, got = Forest(), Forest()
        for i in range(len(sets)):
            for j in range(i):
                k = len(np.intersect1d(sets[i], sets[j]))
                if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                    want.link(i, j)
        for i, j in jaccard_join.family_links(sets):
            got.link(i, j)
        assert [want.root(i) for i in range(len(sets))] == [got.root(i) for i in range(len(sets))], case


def test_shingles_against_strings():
    texts = ["A b\tc\x0bd e F", "a b c d e f", "one TWO", "One two", "x", "", None, " \n", "é ß d e f g h", "a b c d e a b c d e"]
    sets = shingles.Shingler().sets(texts, run_bytes=12)
    assert [len(s) for s in sets] == [2, 2, 1, 1, 1, 0, 0, 0, 2, 5]
    assert (sets[0] == sets[1]).all() and (sets[2] == sets[3]).all()
    assert shingles.set_name(sets[5]) is None


def test_phrases_and_templates():
    words = license_scan.words_of("MIT License, mit license; The GNU General Public-License")
    assert license_scan.phrase_places(words, [b"mit", b"license"]) == [0, 2]
    index = license_scan.TemplateIndex([("a", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), ("none", "")], {b"w1": 5})
    nine = {f"w{i}".encode() for i in range(2, 11)}
    assert index.matches(nine) == [("a", 0.9)] and index.matches(nine - {b"w9"}) == [] and index.matches(nine | {b"z"}) == [("a", 0.9)]


def test_block_max_search_loses_no_neighbour():
    r = np.random.default_rng(2)
    vectors = []
    for _ in range(300):
        f = np.sort(r.choice(30, r.integers(1, 6), replace=False))
        w = r.random(len(f)) + 0.1
        vectors.append((f, w / np.sqrt((w**2).sum())))
    index = toxicity.BlockMaxIndex.build(vectors, list(range(300)), [0] * 300, 30)
    full = np.zeros((300, 30))
    for i, (f, w) in enumerate(vectors):
        full[i, f] = w
    for f, w in vectors[:50]:
        query = np.zeros(30)
        query[f] = w
        cosines = np.round(full @ query, 12)
        want = sorted(np.flatnonzero(cosines > 0).tolist(), key=lambda i: (-cosines[i], i))[:10]
        assert index.ids[index.nearest(f, w, 10)[0]].tolist() == want


def test_isotonic_steps_rise():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.9]), np.array([0, 1, 0, 1.0]))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and 0 < y[0] < y[-1] < 1


def test_group_ends_find_the_smallest_capacity():
    r = random.Random(4)
    for _ in range(50):
        sizes = [r.randint(1, 30) for _ in range(r.randint(1, 60))]
        ends = np.cumsum(sizes).tolist()
        known = shards.GroupEnds(ends[-1], len(ends))
        while known.open:
            start, stop = known.stretch(min(known.open))
            inside = [e for e in ends if start < e < stop]
            half = (start + stop) // 2
            known.refine(start, [(c[0], c[-1], len(c)) for c in ([e for e in inside if e <= half], [e for e in inside if e > half]) if c])
        capacity = known.smallest(max(sizes), 4, False)

        def shards_for(c):
            n, room = 1, c
            for s in sizes:
                if s > room:
                    n, room = n + 1, c
                room -= s
            return n

        assert shards_for(capacity) <= 4 and (capacity == max(sizes) or shards_for(capacity - 1) > 4)
