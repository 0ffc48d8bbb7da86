"""The task-side parts of the operators against plain versions (no Spark)."""

import hashlib
import random

import numpy as np
import pytest

from strata.llm import lm_scoring, packing, simhash, suffix_dedup


def _components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("radius", [1, 4, 7])
@pytest.mark.parametrize("n", [1, 2, 64, 65, 400])
def test_bit_sliced_links_equal_plain_distances(radius, n):
    rng = random.Random(n * 10 + radius)
    base = [rng.getrandbits(64) for _ in range(max(1, n // 8))]
    fps = []
    for _ in range(n):
        f = rng.choice(base)
        for _ in range(rng.randrange(0, 2 * radius)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    fps = np.array(sorted(fps), dtype=np.uint64)
    cells = np.zeros(n, dtype=np.int64)
    links = [
        (i, j) for i in range(n) for j in range(i) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius
    ]
    i, root = simhash.link_forest(fps, cells, radius)
    assert _components(n, list(zip(i.tolist(), root.tolist()))) == _components(n, links)
    assert len(i) < max(n, 1)


def test_cells_widen_with_the_number_of_fingerprints():
    assert [simhash.blocks_that_agree(n) for n in (0, 10**6, 2**24, 2**24 + 1, 10**9, 10**12)] == [1, 1, 1, 2, 2, 4]
    for radius in (1, 4, 7):
        for agree in (1, 2, 3):
            masks = [m & (1 << 64) - 1 for m in simhash.cell_masks(radius, agree)]
            rng = random.Random(radius * agree)
            for _ in range(50):
                flips = sum(1 << b for b in rng.sample(range(64), radius))
                assert any(not flips & m for m in masks)  # a pair within the radius shares a cell


def test_hilbert_key_visits_every_cell_by_neighbour_steps():
    for dims, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        grid = np.array(np.meshgrid(*[range(side)] * dims, indexing="ij")).reshape(dims, -1).T
        key = packing.hilbert_key(grid, bits)
        assert sorted(key.tolist()) == list(range(side**dims))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_encoder_equals_the_tokenizers_library():
    enc = packing.encoder()
    texts = [
        "", " ", "a", "Hello world", "  two  spaces ", "end \n\n next", "tab\tx y", "x <|endoftext|> y",
        "Größe über alles    é", "1234 56 7.8!! ***", "🙂 emoji 🙂🙂", "don't we'll I'VE", "a" * 5000, " " * 300 + "b",
    ]
    for t in texts:
        want = enc.whole.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(enc(t), "<u2").tolist() == want, t
        assert np.frombuffer(enc(t), "<u2").tolist() == want, t  # from the cache


@pytest.mark.parametrize("space", [" ", "\n", "\u3000"])
def test_encoder_takes_very_long_runs_of_white_space(space):
    from tokenizers import Tokenizer
    import public_tokenizers

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "a b" + space * 2_000_000 + "c d"
    want = whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encoder()(text), "<u2").tolist() == want


def test_encoder_gives_the_ids_of_added_tokens():
    from tokenizers import Tokenizer
    import public_tokenizers

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.encoder()
    assert np.frombuffer(enc("a <|endoftext|> b"), "<u2").tolist() == [64, 220, 50256, 275]
    for t in ["<|endoftext|>", "x<|endoftext|><|endoftext|>y", "a  <|endoftext|>\n\n b <|endoftext", " <|endoftext|> <|endoftext|>"]:
        assert np.frombuffer(enc(t), "<u2").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_encoder_leaves_a_panic_of_the_fast_library_to_the_other(monkeypatch):
    class PanicException(BaseException):
        pass

    class Fast:
        def __init__(self, error):
            self.error = error

        def encode_ordinary(self, text):
            raise self.error

    enc = packing.encoder()
    monkeypatch.setattr(enc, "fast", Fast(PanicException()))
    assert np.frombuffer(enc.encode("some text"), "<u2").tolist() == enc.whole.encode("some text", add_special_tokens=False).ids
    monkeypatch.setattr(enc, "fast", Fast(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        enc.encode("some text")


def _plain_order(strings):
    order = sorted(range(len(strings)), key=lambda i: strings[i])
    lcps = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while n < min(len(strings[a]), len(strings[b])) and strings[a][n] == strings[b][n]:
            n += 1
        lcps.append(n)
    return order, lcps


def test_deep_shallow_order_equals_plain_sort():
    rng = random.Random(5)
    for _ in range(60):
        stem = bytes(rng.choices(b"ab", k=120))
        strings = {stem[: rng.randrange(0, 120)] + bytes(rng.choices(b"ab", k=rng.randrange(0, 40))) for _ in range(40)}
        strings = list(strings)
        assert suffix_dedup.suffix_order(strings) == _plain_order(strings)


def plain_strip(texts, length):
    """Repeated strings by counting every one."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_anchors_cover_every_window_and_agree_on_equal_windows():
    rng = random.Random(3)
    text = bytes(rng.choices(b"abcd", k=3000))
    data = np.frombuffer(text + text[500:1500] + b"aaaa" * 300, np.uint8)
    h, place, first, last = suffix_dedup.anchors(data, 40, 12)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert covered.tolist() == list(range(len(data) - 39))
    chosen = {}
    for p, a, b in zip(place, first, last):
        for s in range(a, b + 1):
            assert s <= p <= s + 28
            w = data[s : s + 40].tobytes()
            assert chosen.setdefault(w, p - s) == p - s


def test_context_hash_of_the_word_prefix_depends_on_the_prefix_only():
    a = lm_scoring.context_keys(lm_scoring.line_of([b"the", b"theory"]))[-2]
    assert a[0] == a[4] and a[1] == a[5] and a[2] == a[6] and a[3] != a[1]


def test_trees_are_prefix_free_and_complete():
    rng = np.random.default_rng(2)
    tree = lm_scoring.build_tree(rng.integers(0, 50, (256, 256)) ** 2)
    for p in range(lm_scoring.SYMBOLS):
        assert abs((2.0 ** -tree.length[p]).sum() - 1) < 1e-9
        codes = {tuple(tree.code[p, b, : tree.length[p, b]]) for b in range(lm_scoring.SYMBOLS)}
        assert len(codes) == lm_scoring.SYMBOLS
    escaped = tree.symbol == lm_scoring.SYMBOLS - 1
    assert abs((2.0 ** -tree.extra[escaped]).sum() - 1) < 1e-9 and not tree.extra[~escaped].any()


def test_weights_of_every_gate_are_refined_in_short_documents():
    tree = lm_scoring.build_tree(np.ones((256, 256)))
    words = [b"ab"] * 40  # 120 bytes, about 960 bits
    line = lm_scoring.line_of(words)
    table = np.concatenate((np.zeros(256), np.full(256, -1.0), np.full(256, 1.0))).astype(np.float32)
    starts = np.zeros((len(lm_scoring.ORDERS), len(line)), np.int64)
    starts[lm_scoring.GATE[0], ::2] = 256  # one of the gate's contexts is known at every other byte
    starts[0] = 512
    cost, size, weights, seen = lm_scoring.Model(tree, [table] * len(lm_scoring.ORDERS)).coded(words, starts)
    start = np.array(lm_scoring.START, np.float32)
    assert size == len(line) and seen[0] > 0 and seen[1] > 0 and seen[2] == 0
    moved = weights - start
    assert moved[0, 0] != 0 and moved[1, 0] != 0 and moved[1, lm_scoring.GATE[0]] != 0
    assert abs(moved[0, 0] - moved[1, 0]) > 1e-4 and not moved[2].any()  # each gate learns by itself


def test_runs_of_anchors_stand_for_the_same_anchors():
    rng = random.Random(9)
    text = b"abc " * 200 + bytes(rng.choices(b"abcd", k=500)) + b"z" * 300 + b"xy" * 100
    found = suffix_dedup.anchors(np.frombuffer(text, np.uint8), 40, 12)
    h, place, first, last, step, reps = suffix_dedup.anchor_runs(*found)
    spread = [
        (h[i], place[i] + k * step[i], first[i] + k * step[i], last[i] + k * step[i])
        for i in range(len(h))
        for k in range(reps[i])
    ]
    assert spread == list(zip(*found)) and len(h) < len(found[0]) / 2
