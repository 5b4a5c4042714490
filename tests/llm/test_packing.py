import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from perennial.llm import matrices, packing, tokens

TEXTS = [
    None, "", "a", "plain words here.", "  lead and  double\n\nspace\t", "<|endoftext|> inside", "é ü 日本 😀 ½", "it's they'll 'LL I'd", "a\x0bb\xa0c d",
    "x" * 5000, "word " * 9000, "\n", " ", "\x1c\x1d", "tail ",
]


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(3)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(f"tok{rng.randint(0, 99)}" for _ in range(rng.randint(1, 1500)))) for i in range(60)]
    rows += [(3, "plain words here."), (None, "no id")]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, length int, sequence_id int")


def test_ids_are_the_tokenizers(sf_dir):
    import duckdb

    encoder = tokens.encoder()
    given = [r[0] for r in duckdb.sql(f"select text from '{sf_dir}/documents.parquet'").fetchall()]
    for text in TEXTS + given:
        wanted = encoder.tokenizer.encode(text, add_special_tokens=False).ids if text else []
        assert encoder.encode(text).tolist() == wanted, text


def test_pieces_fill_sequences_without_gaps(documents):
    rows, df = documents
    encoder = tokens.encoder()
    wanted = Counter()
    for doc_id, text in rows:
        whole = np.append(encoder.encode(text), np.uint32(0)).astype("<u4")
        for number, (a, b) in enumerate(packing.cuts(len(whole))):
            wanted[doc_id, number, a, b - a, zlib.crc32(whole[a:b].tobytes())] += 1
    for group in (20_000, 7):
        out = packing.pack(df, group=group).collect()
        assert Counter(tuple(r)[:5] for r in out) == wanted
        held = defaultdict(list)
        for r in out:
            held[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in held.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
        least = -(-sum(r["length"] for r in out) // 2048)
        assert len(held) <= (least + 1 if group > 100 else least + 12)


def test_cuts_put_the_short_piece_first():
    assert packing.cuts(2048) == [(0, 2048)]
    assert packing.cuts(4097) == [(0, 1), (1, 2049), (2049, 4097)]
    assert packing.cuts(4096) == [(0, 2048), (2048, 4096)]


def fewest(sizes, length):
    """The fewest bins, by trying every place for every item."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= length:
                bins[b] += sizes[i]
                place(i + 1, bins)
                bins[b] -= sizes[i]
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_local_search_is_near_the_fewest_bins():
    rng = random.Random(5)
    over = 0
    for _ in range(60):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 9))]
        where, offset, fill = packing.assign(np.array(sizes), 100)
        assert max(fill) <= 100 and sum(fill) == sum(sizes)
        over += len(fill) - fewest(sorted(sizes, reverse=True), 100)
    assert over <= 1


def test_steps_never_lower_the_squared_fill_and_lose_nothing():
    rng = random.Random(9)
    sizes = [rng.randint(300, 1100) for _ in range(400)]
    bins = packing.Bins(sizes)
    # a poor start: every item in a bin of its own
    bins.items, bins.fill = [Counter([s]) for s in sizes], list(sizes)
    before = sum(f * f for f in bins.fill)
    bins.improve()
    assert sum(f * f for f in bins.fill) > before
    assert sum((c for c in bins.items), Counter()) == Counter(sizes)
    assert len(bins.fill) <= 1.05 * sum(sizes) / 2048 + 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none).count() == 0
    assert matrices.pack(none).count() == 0


def test_matrices_round_trip(spark, documents, tmp_path):
    rows, df = documents
    packed = matrices.pack(df, run_tokens=30_000)
    path = str(tmp_path / "matrices")
    matrices.write(matrices.pack_matrices(df, run_tokens=30_000, rows=4), path)
    sequences = {r["sequence_id"]: r for r in packed.collect()}
    found = defaultdict(list)
    for m in spark.read.parquet(path).collect():
        ids, positions = (matrices.matrix(m[n], m["n_rows"], m["length"]) for n in ("ids", "positions"))
        lengths, at = np.diff(m["cu_seqlens"]), 0
        for row, n_segments in enumerate(m["row_segments"]):
            sequence = sequences[m["matrix_id"] + row]
            place = 0
            for k in range(n_segments):
                n = int(lengths[at])
                at += 1
                assert positions[row, place : place + n].tolist() == list(range(n))
                found[sequence["doc_ids"][k]].append((sequence["doc_starts"][k], ids[row, place : place + n].tolist()))
                place += n
            assert place == sequence["n_tokens"] and (ids[row, place:] == matrices.PAD_ID).all()
    stacked = matrices.matrices(packed, rows=4)
    assert {r["sequence_id"] for r in matrices.sequences(stacked).collect()} == set(sequences)
    apart = {r["sequence_id"]: r for r in matrices.sequences(matrices.read(spark, path)).collect()}
    assert apart == {i: r for i, r in sequences.items()}
    encoder = tokens.encoder()
    wanted = defaultdict(list)
    for doc_id, text in rows:
        whole = [*encoder.encode(text).tolist(), matrices.END_ID]
        wanted[doc_id] += [(a, whole[a : a + 2048]) for a in range(0, len(whole), 2048)]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_segment_tree_finds_the_smallest_capacity():
    rng = random.Random(1)
    tree, there = matrices.CapacityTree(100), []
    for step in range(2000):
        if rng.random() < 0.5 or not there:
            capacity = rng.randint(1, 100)
            tree.put(capacity, step)
            there.append(capacity)
        else:
            least = rng.randint(1, 100)
            fitting = [c for c in there if c >= least]
            found = tree.take(least)
            assert (found and found[0]) == (min(fitting) if fitting else None)
            if found:
                there.remove(found[0])


def test_best_fit_decreasing_is_the_plain_one():
    rng = random.Random(8)
    for length in (10, 97, 2048):
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 300))]
        bins, room = [], []
        for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fitting = [(r, b) for b, r in enumerate(room) if r >= sizes[item]]
            if fitting:
                least = min(fitting)[0]
                b = next(b for r, b in fitting if r == least)
            else:
                b = len(bins)
                bins.append([])
                room.append(length)
            bins[b].append(item)
            room[b] -= sizes[item]
        found = matrices.best_fit_decreasing(sizes, length)
        # among bins of one capacity either may be taken, so sizes and capacities are compared
        assert sorted(i for b in found for i in b) == list(range(len(sizes)))
        assert sorted(sum(sizes[i] for i in b) for b in found) == sorted(length - r for r in room)


def test_the_search_ends_in_a_local_optimum():
    rng = random.Random(11)
    for low, high, n in ((300, 700, 1500), (550, 900, 1500), (20, 400, 800)):
        bins = packing.Bins([rng.randint(low, high) for _ in range(n)])
        lowering, steps = [], 0
        shift = bins._shift

        def counted(source, target, given, taken):
            nonlocal steps
            before = sum(f * f for f in bins.fill)
            shift(source, target, given, taken)
            steps += 1
            lowering.append(sum(f * f for f in bins.fill) <= before)

        bins._shift = counted
        bins.improve()
        assert steps and not any(lowering)
        steps = 0
        bins.improve()
        assert steps == 0


def test_two_for_one_looks_at_every_bin():
    bins = packing.Bins([1], 100)
    # the pairs that fill the first bin lie before thirty emptier bins that have none
    bins.items = [Counter({60: 1, 30: 1}), Counter({45: 1, 25: 1, 15: 1})] + [Counter({45: 1}) for _ in range(30)]
    bins.fill = [sum(size * n for size, n in counts.items()) for counts in bins.items]
    before = sum((Counter(counts) for counts in bins.items), Counter())
    bins.improve()
    assert max(bins.fill) == 100
    assert sum((Counter(counts) for counts in bins.items), Counter()) == before
