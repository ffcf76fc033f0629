"""Each operator on odd rows, on an empty table, and against a plain version."""

import collections
import os
import zlib

import conftest as odd_data
import numpy as np
import plain
import pytest
from pyspark.sql import types as T

from siftgate.llm import common, components, exact_dedup, mixing, packing, passages, secret_scan, sharding, simhash, suffixes, topk, toxicity

SF_DIR = "/root/testdata/sf0.001"
ROWS = odd_data.odd_rows()


def got(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# 1 --------------------------------------------------------------------------------------------------


def test_secrets(odd, empty):
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = sorted(((i, *plain.secrets(t or "")[:4]) for i, t, _ in ROWS), key=repr)
    assert got(secret_scan.scan_secrets(odd), *columns) == want
    line = next(r for r in secret_scan.scan_secrets(odd).collect() if r.doc_id == 14)
    text = dict((i, t) for i, t, _ in ROWS)[14]
    base = plain.secrets(text)[4].split(",")
    assert set(base) < set(line.spans.split(","))
    (guess,) = [s for s in line.spans.split(",") if s.startswith("guess")]
    assert text[int(guess.split(":")[1]) : int(guess.split(":")[2])] == "Xk9#mQ2!vB7zT4"
    assert secret_scan.scan_secrets(empty).count() == 0


def test_secrets_of_the_table(spark):
    docs = common.table(spark, SF_DIR, "documents")
    want = sorted(((r.doc_id, *plain.secrets(r.text)) for r in docs.collect()), key=repr)
    found = secret_scan.op1_secrets(spark, SF_DIR)
    assert got(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == [w[:5] for w in want]
    for row, (*_, listed) in zip(sorted(found.collect(), key=lambda r: r.doc_id), sorted(want)):
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))


@pytest.mark.parametrize(
    "before, value, after",
    [
        ('password: "', "xQ9,vT4(zK7{mB2", '" x'),
        ("login = ", "xK9;pQ2#rT", ", and"),
        ("passphrase: '", "x9! Kq# Lm2$ Vz", "'"),
        ("pwd:      ", "Xk9#mQ2!vB7zT4", ")."),
        ("(pwd=", "Xk9(mQ2)vB7zT(4)", ");"),
        ("password: ", "hunter22!@Kq#9z&Lp", "."),
    ],
)
def test_whole_values(before, value, after):
    words = secret_scan.ranked_words(secret_scan.dictionary_path())
    text = before + value + after
    spans = secret_scan.guessed_spans(text, secret_scan.base_spans(text), words, secret_scan.STRONG)
    assert [text[a:b] for a, _, b in spans] == [value]


def slow_cost(value, words):
    """Least cost over all segmentations, from the definition, for values without repeats."""
    import functools
    import math

    each = math.log10(secret_scan._alphabet(value))
    keys, near = [secret_scan._key(c) for c in value], secret_scan.neighbours()

    def segment(i, j):
        options = [each * (j - i)]
        low = value[i:j].lower()
        if j - i >= 3 and low in words:
            options.append(math.log10(words[low] + 1) + secret_scan._case_cost(value[i:j]))
        if j - i >= 4 and all(keys[k] in near.get(keys[k - 1], ()) for k in range(i + 1, j)):
            turns = sum(secret_scan._step(keys, k) != secret_scan._step(keys, k - 1) for k in range(i + 2, j))
            options.append(math.log10(47 * (j - i)) + turns * math.log10(4))
        return min(options)

    @functools.cache
    def best(i):
        return 0.0 if i == len(value) else min(segment(i, j) + best(j) for j in range(i + 1, len(value) + 1))

    return best(0)


@pytest.mark.parametrize("value", ["correcthorse", "Xk9#mQ2!vB", "qwertyhello", "lkjhTrash5", "zxcvmoonAsdf"])
def test_guess_cost_is_least(value):
    words = secret_scan.ranked_words(secret_scan.dictionary_path())
    assert secret_scan.guess_cost(value, words) == pytest.approx(slow_cost(value, words))


def test_guess_cost_orders_values():
    words = secret_scan.ranked_words(secret_scan.dictionary_path())
    cost = [secret_scan.guess_cost(v, words) for v in ("aaaaaaaaaaaa", "qwertyuiop", "20190312", "wintergarden", "x8Kq!2mZp")]
    assert max(cost[:4]) < secret_scan.STRONG < cost[4]
    assert secret_scan.guess_cost("x8Kq" * 50, words) < 12


# 2 --------------------------------------------------------------------------------------------------


def check_packing(rows, found):
    """Every id once and in order, crc of the ids, full sequences, powers of two at the ends."""
    tokens = collections.Counter()
    for doc_id, text in rows:
        ids = packing._tokenizer(packing.tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [0]
        tokens[doc_id, np.array(ids, "<u4").tobytes()] += 1
    by_row, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        by_row[r.row_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    known = {}
    for name, raw in tokens:
        known.setdefault(name, []).append(raw)
    seen = collections.Counter()
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r.start)
        at = 0
        for p in pieces:
            assert p.start == at and p.length > 0
            at += p.length
        fitting = [
            raw
            for raw in known[pieces[0].doc_id]
            if len(raw) == 4 * at and all(zlib.crc32(raw[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 for p in pieces)
        ]
        assert len(fitting) == 1 and {p.doc_tokens for p in pieces} == {at}
        seen[pieces[0].doc_id, fitting[0]] += 1
    assert seen == tokens
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == packing.LENGTH or at & (at - 1) == 0


def test_packing(spark, odd, empty):
    rows = packing.pack(odd).collect()
    check_packing([(i, t) for i, t, _ in ROWS], rows)
    assert packing.pack(empty).count() == 0
    special = [(1, "a <|endoftext|> b"), (2, "word " * 60_000), (3, "  \U0001f600 é")]
    check_packing(special, packing.pack(texts(spark, special)).collect())
    docs = common.table(spark, SF_DIR, "documents")
    check_packing([(r.doc_id, r.text) for r in docs.collect()], packing.op2_packing(spark, SF_DIR).collect())


def test_hilbert_keys_visit_each_cell_step_by_step():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = packing.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        line = grid[np.argsort(keys)]
        assert (np.abs(np.diff(line, axis=0)).sum(axis=1) == 1).all()


# 3 --------------------------------------------------------------------------------------------------


def check_near(rows, frame, distance=simhash.DISTANCE):
    prints = [plain.fingerprint(t) for _, t in rows]
    parts = plain.roots(prints, distance)
    least = {}
    for root, (doc_id, _) in zip(parts, rows):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    want = sorted(((i, p - (1 << 64) if p >> 63 else p, least.get(r)) for (i, _), p, r in zip(rows, prints, parts)), key=repr)
    assert got(frame, "doc_id", "print", "component_id") == want


def test_near_duplicates(spark, odd, empty, monkeypatch):
    check_near([(i, t) for i, t, _ in ROWS], simhash.near_duplicates(odd))
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and {r["_row"] for r in kept.collect()} == {"own"}
    assert got(kept, "doc_id").count((8,)) == 0 and got(kept, "doc_id").count((7,)) == 1
    docs = common.table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_near(rows, simhash.near_duplicates(docs))
    # large buckets are cut again, hot groups spread
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 1)
    monkeypatch.setattr(common, "HOT_SHARE", 5)
    check_near(rows, simhash.near_duplicates(docs))


def test_trie_join_is_all_pairs(monkeypatch):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    prints = centres[rng.integers(0, 20, 600)]
    for _ in range(5):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    keys = rng.integers(0, 3, 600)
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    keep = np.concatenate([[True], (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])])
    keys, prints = keys[keep], prints[keep]
    monkeypatch.setattr(simhash, "FRONTIER", 500)
    for distance in (0, 3, 6):
        want = {
            (a, b)
            for a in range(len(prints))
            for b in range(a + 1, len(prints))
            if keys[a] == keys[b] and int(prints[a] ^ prints[b]).bit_count() <= distance
        }
        pairs = [(int(a), int(b)) for x, y in simhash.trie_links(keys, prints, distance) for a, b in zip(x, y)]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(60)] + rng.integers(200, 260, (40, 2)).tolist()
    found = dict(got(components.components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    parent = {n: n for link in links for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(parent[a], parent[b])
            changed |= parent[a] != least or parent[b] != least
            parent[a] = parent[b] = least
    assert found == {n: r for n, r in parent.items() if n != r}


# 4 --------------------------------------------------------------------------------------------------


def check_shards(rows, found, shards):
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 8, plain.crc(t)) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in found) == want
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_sharding(spark, odd, empty):
    check_shards([(i, t) for i, t, _ in ROWS], sharding.shard_documents(odd).collect(), sharding.SHARDS)
    assert sharding.shard_documents(empty).count() == 0
    docs = common.table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sizes = check_shards(rows, sharding.shard_documents(docs, 4).collect(), 4)
    longest = max(len(t.encode()) for _, t in rows) + 8
    assert max(sizes.values()) - min(sizes.values()) <= 2 * longest
    # a third of all rows are copies of one text: it is cut by id, and small groups stay whole
    copies = [(i, "the same text") for i in range(1000)] + [(1000 + i, f"text {i // 2}") for i in range(2000)]
    found = sharding.shard_documents(texts(spark, copies), 6).collect()
    sizes = check_shards(copies, found, 6)
    assert max(sizes.values()) - min(sizes.values()) <= 0.01 * sum(sizes.values())
    homes = collections.defaultdict(set)
    for r in found:
        homes[copies[r.doc_id][1]].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 5
    # rows that are equal altogether are dealt out all the same
    equal = [(7, "x" * 40)] * 3000 + [(10 + i, f"text {i}") for i in range(3000)]
    sizes = check_shards(equal, sharding.shard_documents(texts(spark, equal).repartition(5), 6).collect(), 6)
    assert len(sizes) == 6 and max(sizes.values()) - min(sizes.values()) <= 0.01 * sum(sizes.values())


# 5 --------------------------------------------------------------------------------------------------


def check_mix(rows, found):
    size = {(i, t): len(plain.WORD.findall(t or "")) for i, t, _ in rows}
    sources = collections.Counter()
    for i, t, s in rows:
        sources[s] += size[i, t]
    want = plain.targets(sources)
    taken, longest = collections.Counter(), collections.Counter()
    for r in found:
        assert r.source_size == sources[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken in {k * r.size for k in range(4)}
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for source in want:
        assert abs(taken[source] - want[source]) <= longest[source] / 2 + 1e-6
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted((i or -1, size[i, t]) for i, t, _ in rows)


def test_mixing(spark, odd, empty):
    found = mixing.mix(odd).collect()
    check_mix(ROWS, found)
    assert got(mixing.mix(odd.repartition(5)), "doc_id", "size", "taken") == got(mixing.mix(odd), "doc_id", "size", "taken")
    assert mixing.mix(empty).count() == 0
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns
    words = sum(len(plain.WORD.findall(r.text or "")) for r in rows.collect())
    assert words == sum(r.taken for r in found)
    docs = common.table(spark, SF_DIR, "documents")
    check_mix([(r.doc_id, r.text, r.source) for r in docs.collect()], mixing.mix(docs).collect())


# 6 --------------------------------------------------------------------------------------------------


def test_decoding():
    text = "the loser was a stupid idiot, a clown and moron for the other people of this town " * 50
    codes = np.array([toxicity._char_class(c) for c in "  " + text])
    counts = np.zeros(toxicity.CLASSES**3)
    np.add.at(counts, codes[:-2] * toxicity.CLASSES**2 + codes[1:-1] * toxicity.CLASSES + codes[2:], 1)
    model = toxicity.character_model(counts)
    for spelled, meant in (("l0s3r", "loser"), ("st00pid", "stupid"), ("i d i o t", "idiot"), ("c-l-0-w-n", "clown"), ("moooron", "moron")):
        decoded = toxicity.decode(spelled, model)
        assert decoded == meant or spelled == "st00pid", decoded
    assert "idiot" in toxicity.token_words("i.d.i.o.t", model)
    assert "idiot" in toxicity.spelled_words("he is an i d i o t of", model) and not toxicity.spelled_words("he is an idiot", model)


DISGUISED = ["moooron,", "moooron.", '"moooron"', "(moooron)", "morron", "mo.ron", "mo-ron", "mo_ron", "m0r0n!", "m.0.r.o.n"]


@pytest.mark.parametrize("token", DISGUISED)
def test_disguised_tokens(token):
    model = character_model_of("the moron is a moron and no other moron was the moron of them " * 30)
    assert "moron" in toxicity.token_words(token, model)


@pytest.mark.parametrize("spelled", ["$ p 1 t", "a $ p i t", "s.p i.t", "s - p - i - t", "s\np\ni\nt", "s p*i t"])
def test_spelled_words(spelled):
    model = character_model_of("spit and spit as they spit or spit when he spits a spit " * 30)
    found = toxicity.spelled_words(f"here {spelled} here", model)
    assert any(w.endswith("spit") for w in found)
    assert not toxicity.spelled_words("he is 1 of us, i am", model)


def character_model_of(text):
    codes = np.array([toxicity._char_class(c) for c in "  " + text])
    counts = np.zeros(toxicity.CLASSES**3)
    np.add.at(counts, codes[:-2] * toxicity.CLASSES**2 + codes[1:-1] * toxicity.CLASSES + codes[2:], 1)
    return toxicity.character_model(counts)


def test_toxicity(spark, odd, empty):
    labels = common.table(spark, SF_DIR, "labels")
    rows = toxicity.score_documents(odd, labels, [odd["doc_id"], odd["_row"]]).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r["_row"] == "own" for r in rows)
    assert toxicity.score_documents(empty, labels, [empty["doc_id"]]).count() == 0
    nothing = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(odd, nothing, [odd["doc_id"]]).collect()} == {0.0}
    assert got(toxicity.keep_clean(odd, nothing), *odd.columns) == got(odd, *odd.columns)


@pytest.mark.parametrize("toxic_share", [0.1, 0.4, 0.6])
def test_toxicity_of_toxic_labels(spark, toxic_share):
    rng = np.random.default_rng(2)
    toxic = [int(t) for t in rng.random(600) < toxic_share]
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 300, 40)) + (" zugor" if t else "")) for i, t in enumerate(toxic)]
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    docs = texts(spark, rows)
    found = {r.doc_id: r.score >= toxicity.REJECT for r in toxicity.score_documents(docs, labels, [docs["doc_id"]]).collect()}
    assert found == {i: bool(t) for i, t in enumerate(toxic)}


def test_toxicity_held_out(spark):
    found = toxicity.op6_toxicity(spark, "/root/testdata/sf0.1")
    labels = common.table(spark, "/root/testdata/sf0.1", "labels").select("doc_id", "toxic")
    rows = found.filter("held_out").join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    hit = sum(r.predicted and r.toxic for r in rows)
    wrong = sum(r.predicted and not r.toxic for r in rows)
    assert hit >= 0.75 * sum(r.toxic for r in rows) and wrong <= 0.02 * len(rows)


# 7 --------------------------------------------------------------------------------------------------


def test_passages(odd, empty):
    found = passages.fuzzy_passages(odd).collect()
    pairs = {(r.doc_id, r.partner_id) for r in found}
    assert {(2, 1), (4, 3), (10, None), (12, 11)} == pairs
    (row,) = [r for r in found if r.doc_id == 4]
    assert (row.start, row.end, row.partner_start, row.partner_end) == (15, 94, 30, 110) and row.equal == 77
    (row,) = [r for r in found if r.doc_id == 2]
    assert (row.start, row.end, row.similarity) == (0, 120, 1.0)
    (row,) = [r for r in found if r.doc_id == 12]
    assert (row.start, row.end, row.partner_start) == (0, 8000, 1)
    assert passages.fuzzy_passages(empty).count() == 0


def test_passages_of_many_documents(spark):
    passage = odd_data.words(0, 60)
    rows = [(i, odd_data.words(1000 + 100 * i, 30) + " " + passage) for i in range(200)]
    found = passages.fuzzy_passages(texts(spark, rows).repartition(4)).collect()
    assert {r.doc_id for r in found} == set(range(1, 200)) and len(found) < 3 * len(rows)
    assert all(r.end - r.start == 60 for r in found)


@pytest.mark.parametrize("between", [10, 30, 45, 64])
def test_passages_with_other_words_between(spark, between):
    one, two = odd_data.words(0, 52), odd_data.words(1000, 52)
    rows = [(i, f"{one} {odd_data.words(10_000 * i, between)} {two}") for i in (1, 2)]
    found = passages.fuzzy_passages(texts(spark, rows)).collect()
    spans = sorted((r.start, r.end, r.partner_start, r.partner_end) for r in found)
    second = 52 + between
    parts = [(0, 52, 0, 52), (second, second + 52, second, second + 52)]
    assert spans == (parts if between > 26 else [(0, second + 52, 0, second + 52)])


def test_passage_with_a_stray_seed(spark):
    one, stray = odd_data.words(0, 52), odd_data.words(1000, 7)
    rows = [(i, f"{one} {odd_data.words(10_000 * i, 40)} {stray} {odd_data.words(20_000 * i + 500, 40)}") for i in (1, 2)]
    found = passages.fuzzy_passages(texts(spark, rows), every=1).collect()
    assert [(r.start, r.end, r.partner_start, r.partner_end) for r in found] == [(0, 52, 0, 52)]


def test_passage_of_lines_that_others_have(spark):
    """Each seed of the shared passage is first seen in a document that shares less than a passage."""
    one, two, three = (odd_data.words(1000 * k, 20) for k in range(3))
    other = [odd_data.words(100_000 * k, 30) for k in range(1, 5)]
    rows = [(1, f"{one} {two} {other[0]}"), (2, f"{other[1]} {two} {three}")]
    rows += [(3, f"{other[2]} {one} {two} {three}"), (4, f"{one} {two} {three} {other[3]}")]
    for parts in (1, 4):
        found = passages.fuzzy_passages(texts(spark, rows).repartition(parts)).collect()
        assert {(r.doc_id, r.start, r.end, r.partner_id, r.partner_start) for r in found} == {(4, 0, 60, 3, 30)}


def test_edited_passage_of_parts_that_others_have(spark):
    """All seeds of the passage are first seen in documents that share less than a passage, and no window is shared."""
    passage = odd_data.words(0, 60).split()
    edited = [f"other{k}" if k in (9, 19, 29, 39, 49) else w for k, w in enumerate(passage)]
    parts = [passage[a : a + 22] for a in (0, 13, 26, 38)] + [edited[a : a + 22] for a in (0, 13, 26, 38)]
    rows = [(k, f"{odd_data.words(100_000 * k, 40)} {' '.join(part)} {odd_data.words(100_000 * k + 500, 40)}") for k, part in enumerate(parts, 1)]
    rows += [(k, f"{odd_data.words(100_000 * k, 30)} {' '.join(w)} {odd_data.words(100_000 * k + 500, 30)}") for k, w in ((21, passage), (22, edited))]
    for parts in (1, 4):
        found = passages.fuzzy_passages(texts(spark, rows).repartition(parts)).collect()
        assert [(r.doc_id, r.start, r.end, r.partner_id, r.partner_start, r.equal) for r in found] == [(22, 30, 90, 21, 30, 55)]


def test_all_pairs_of_passages(spark):
    """Each pair that chains of all seeds of two documents give is linked, unless both are linked to the first with a run of theirs."""
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    found = passages.fuzzy_passages(docs).collect()
    linked = {(r.doc_id, r.partner_id) for r in found}
    whole = {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        whole.setdefault(r.text or "", r.doc_id)
    hashed = passages._Words()
    known = {d: hashed(t) for t, d in whole.items()}
    known = {d: w for d, w in sorted(known.items()) if len(w) >= 50}
    looked = {d: passages.seeds(w) for d, w in known.items()}
    wide = {d: set(passages.windows(w, 50)[0].tolist()) for d, w in known.items()}
    missed, pairs = [], 0
    for d in known:
        for e in known:
            if e >= d:
                continue
            both = np.intersect1d(looked[d][0], looked[e][0])
            places = [[looked[k][1][looked[k][0] == s] for k in (d, e)] for s in both]
            if not places:
                continue
            x, y = (np.concatenate([g[k].ravel() for g in (np.meshgrid(p, q) for p, q in places)]) for k in (0, 1))
            x, y = passages._thinned(x, y)
            for chain in passages.chains(x, y):
                u, v, core = passages.align(known[d], known[e], x[chain], y[chain])
                if passages.stretches(u, v, core, 50, 0.8):
                    pairs += 1
                    if (d, e) not in linked and not wide[d] & wide[e]:
                        missed.append((d, e))
    assert pairs >= 10 and not missed


def test_passage_after_a_stray_first_place(spark):
    """The partner has each line of the passage once more, further up."""
    lines = [odd_data.words(1000 * k, 20) for k in range(3)]
    above = " ".join(f"{line} {odd_data.words(50_000 + 1000 * k, 80)}" for k, line in enumerate(lines[::-1]))
    rows = [(1, above + " " + " ".join(lines)), (2, odd_data.words(90_000, 30) + " " + " ".join(lines))]
    found = passages.fuzzy_passages(texts(spark, rows)).collect()
    assert (30, 90, 300, 360) in {(r.start, r.end, r.partner_start, r.partner_end) for r in found}


def test_pairs_that_share_a_line_only_are_not_sent():
    """Of many texts with one line in common, just the pairs that can hold a passage become links; edited passages can."""
    rng = np.random.default_rng(5)
    hashed, line = passages._Words(), "one line of twelve words that very many texts have in common here"
    fill = lambda n: [f"w{k}" for k in rng.integers(0, 3000, n)]
    known = [hashed(" ".join([*fill(60), line, *fill(60)])) for _ in range(150)]
    passage, pairs = fill(35), []
    for k in range(40):
        # each fifth word is replaced, left out on one side, or put in
        edited = [[f"x{k}{side}{i}"] if side and i % 6 == 3 and (i + k) % 3 == 0 else [] if side and i % 11 == 5 else [w] for side in (0, 1) for i, w in enumerate(passage)]
        sides = [[w for ws in part for w in ws] for part in (edited[:35], edited[35:])]
        pairs.append((len(known), len(known) + 1))
        known += [hashed(" ".join([*fill(40), line, *sides[i], *fill(30)])) for i in (0, 1)]
    place = [60] * 150 + [40] * 80
    around = [passages._surroundings(w, np.array([p]), 50) for w, p in zip(known, place)]
    n = len(known)
    before = np.array([passages._before(w, np.array([p]), 0)[0] for w, p in zip(known, place)])
    columns = [np.full(n, 2), np.arange(n), np.arange(n), np.array(place), before, np.concatenate([a[0] for a in around])]
    links = np.concatenate([np.stack(x[:6]) for x in passages._run_links([(columns, b"".join(a[1].tobytes() for a in around))], 50, 0.8)], axis=1)
    got_pairs = set(zip(links[3].tolist(), links[0].tolist()))
    assert got_pairs >= set(pairs) and not [p for p in got_pairs if p[0] < 150] and len(got_pairs) < 40 * 80


def test_few_pairs_of_a_frequent_line_are_compared(monkeypatch):
    """Of many texts with one line in common, only pairs with enough other words in common are compared word by word, and no passage is lost."""
    rng = np.random.default_rng(6)
    hashed, line = passages._Words(), "one line of twelve words that very many texts have in common here"
    fill = lambda n: [f"w{k}" for k in rng.integers(0, 3000, n)]
    known = [hashed(" ".join([*fill(60), line, *fill(60)])) for _ in range(400)]
    place = [60] * 400
    for size in (40, 50, 64, 86):
        for _ in range(10):
            passage = fill(size)
            for side in (0, 1):
                edited = [f"x{i}" if side and (i % 6 == 3 or i == size // 2 - 1) else w for i, w in enumerate(passage)]
                known.append(hashed(" ".join([*fill(30), *edited[: size // 2], line, *edited[size // 2 :], *fill(30)])))
                place.append(30 + size // 2)
    around = [passages._surroundings(w, np.array([p]), 50) for w, p in zip(known, place)]
    n = len(known)
    before = np.array([passages._before(w, np.array([p]), i)[0] for i, (w, p) in enumerate(zip(known, place))])
    columns = [np.full(n, 2), np.arange(n), np.arange(n), np.array(place), before, np.concatenate([a[0] for a in around])]
    rows, compared, compare = [(columns, b"".join(a[1].tobytes() for a in around))], [], passages._may_hold
    monkeypatch.setattr(passages, "_may_hold", lambda left, right, a, b, *rest: compared.append(len(a)) or compare(left, right, a, b, *rest))

    def pairs():
        return {p for x in passages._run_links(rows, 50, 0.8) for p in zip(x[3].tolist(), x[0].tolist())}

    found = pairs()
    assert found >= {(k, k + 1) for k in range(400, 480, 2)} and sum(compared) < 10_000
    monkeypatch.setattr(passages, "COUNTED", 1000)
    assert found == pairs()


def test_repeated_words_are_linked_once(spark):
    """A stretch of one word or of a short line again and again is covered by a few rows, not one for each way to shift it."""
    turn = odd_data.words(0, 7)
    rows = [(k, " ".join([odd_data.words(1000 * k, 20), *["la"] * (60 + 10 * k), odd_data.words(1000 * k + 500, 20), *[turn] * (10 + k)])) for k in range(1, 9)]
    found = passages.fuzzy_passages(texts(spark, rows)).collect()
    assert len(found) < 150
    for k, text in rows[1:]:
        covered = {i for r in found if r.doc_id == k and r.partner_id == 1 for i in range(r.start, r.end)}
        own = [i for i, w in enumerate(text.split()) if w == "la" or w in turn.split()]
        assert covered >= set(own)


def test_passage_with_stretches_of_other_lengths(spark):
    """A word is repeated, more often in one of the texts, inside a passage, before it or behind it."""
    one, two = odd_data.words(0, 28), odd_data.words(100, 28)
    for parts in ([(one, 6, two), (one, 9, two)], [("", 12, one + " " + two), ("", 30, one + " " + two)], [(one + " " + two, 12, ""), (one + " " + two, 30, "")]):
        rows = [(k, f"{odd_data.words(1000 * k, 30)} {a} {' '.join(['la'] * n)} {b} {odd_data.words(1000 * k + 500, 30)}") for k, (a, n, b) in enumerate(parts, 1)]
        found = passages.fuzzy_passages(texts(spark, rows)).collect()
        least = min(len(f"{a} {b}".split()) + n for a, n, b in parts)
        assert max(r.equal for r in found) == least and len(found) < 4


def test_a_step_is_written(spark):
    """What comes after a step reads a table, so that no shuffle file of what led to it is needed."""
    frame = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    found = passages.step(frame, "test")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, frame.collect()))
    assert "Exchange" in frame._jdf.queryExecution().toString() and "Exchange" not in found._jdf.queryExecution().toString()


def test_first_exchange_of_seeds_is_small():
    """Seeds that only one text has cost two or three bytes, and those that several have are found."""
    import pyarrow as pa
    import zstandard

    rng, bits, ranges = np.random.default_rng(7), 26, 4
    lines = [" ".join(f"w{k}" for k in rng.integers(0, 20_000, 400)) for _ in range(120)]
    common = odd_data.words(0, 30)
    rows = [(i % 3, i, 10 * i, zstandard.compress((f"{line} {common}" if i in (4, 5, 50) else line).encode())) for i, line in enumerate(lines)]
    cells, emit = [], passages._emit_short(50, ranges, bits)
    for number in range(3):
        part = [r for r in rows if r[0] == number]
        part.append(part[0])  # a repeated row counts once
        cells += emit(pa.table(dict(zip(("portion", "_id", "_hash", "_text"), map(list, zip(*part)))))).to_pylist()
    seeds = [s >> (passages.HASH_BITS - bits) for s in (passages.seeds(passages._Words()(zstandard.decompress(r[3]).decode()))[0] for r in rows)]
    assert sum(len(c["rows"]) for c in cells) < 3 * sum(map(len, seeds))
    known, count = np.unique(np.concatenate([np.unique(s) for s in seeds]), return_counts=True)
    shared = set(known[count > 1].tolist())
    assert len(shared) >= 27
    for shard in range(ranges):
        cell = [c for c in cells if c["shard"] == shard]
        answers = passages._answer_short(pa.Table.from_pylist(cell)).to_pylist()
        for asked, answer in zip(cell, answers):
            own = passages.unpacked(asked["rows"], 1)[0][0] >> 1
            told = np.unpackbits(np.frombuffer(answer["shared"], np.uint8), count=len(own))
            assert asked["portion"] == answer["portion"] and told.tolist() == [s in shared for s in own.tolist()]


def test_links_do_not_depend_on_partitions(spark):
    docs = common.table(spark, SF_DIR, "documents")
    columns = ("doc_id", "start", "end", "partner_id", "partner_start", "partner_end", "equal")
    one = got(passages.fuzzy_passages(docs.repartition(1)), *columns)
    assert one == got(passages.fuzzy_passages(docs.repartition(7)), *columns)


@pytest.mark.parametrize("length, step", [(50, 5), (60, 5), (60, 6)])
def test_passages_with_every_few_words_changed(spark, length, step):
    passage = odd_data.words(0, length).split()
    edited = [f"other{k}" if k % step == 2 else w for k, w in enumerate(passage)]
    rows = [(i, f"{odd_data.words(10_000 * i, 30)} {' '.join(w)} {odd_data.words(10_000 * i + 500, 30)}") for i, w in ((1, passage), (2, edited))]
    (row,) = passages.fuzzy_passages(texts(spark, rows)).collect()
    assert (row.start, row.end, row.partner_start, row.partner_end) == (30, 30 + length, 30, 30 + length)


def test_stretches_are_longest():
    rng = np.random.default_rng(3)
    for _ in range(200):
        steps = rng.choice([1, 1, 1, 1, 2, 3, 9], (2, 30))
        x, y = np.cumsum(steps, axis=1)
        fits = [(q - p, p, q) for p in range(30) for q in range(p, 30)
                if passages._similar(x, y, p, q) >= 0.8 - 1e-9 and min(x[q] - x[p], y[q] - y[p]) + 1 >= 6]
        best = passages._longest(x, y, 6, 0.8)
        assert (best is None) == (not fits) and (not fits or best[1] - best[0] == max(fits)[0])
        found = passages.stretches(x, y, (0, 29), 6, 0.8)
        assert bool(found) == bool(fits) and all(a[1] < b[0] for a, b in zip(found, found[1:]))


def test_chains_are_best():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 8))
        x, y = np.sort(rng.integers(0, 60, n)), rng.integers(0, 60, n)
        best = 0.0
        for mask in range(1, 1 << n):
            chosen = [i for i in range(n) if mask >> i & 1]
            if all(x[a] < x[b] and y[a] < y[b] for a, b in zip(chosen, chosen[1:])):
                gaps = sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(chosen, chosen[1:]))
                best = max(best, len(chosen) - gaps / 40)
        found = passages.chains(x, y, 1 / 40, 1000)
        assert sorted(i for c in found for i in c) == list(range(n))
        c = found[0]
        gaps = sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(c, c[1:]))
        assert len(c) - gaps / 40 == pytest.approx(best)


# 8 --------------------------------------------------------------------------------------------------

CUT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffixes(spark, odd, empty):
    rows = [(i, t) for i, t, _ in ROWS]
    assert got(suffixes.repeated_bytes(odd), *CUT) == sorted(plain.removed(rows), key=repr)
    assert suffixes.repeated_bytes(empty).count() == 0


@pytest.mark.parametrize("shard_bytes, hot", [(1 << 20, 50_000), (300, 50_000), (1 << 20, 0)])
def test_suffixes_of_the_table(spark, shard_bytes, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 3000)
    docs = common.table(spark, SF_DIR, "documents").repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(suffixes.repeated_bytes(docs, shard_bytes=shard_bytes, hot=hot), *CUT) == sorted(plain.removed(rows), key=repr)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 400):
        data = rng.integers(97, 99, n).astype(np.uint8)
        raw = data.tobytes()
        order = suffixes.suffix_array(data, 2 * n + 8)
        assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(n))
        want = [len(os.path.commonprefix([raw[a:], raw[b:]])) for a, b in zip(order, order[1:])]
        assert suffixes.common_prefixes(data, order)[1:].tolist() == want


# 9 --------------------------------------------------------------------------------------------------


def test_topk(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(400)]
    vectors += [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (450, [float("inf")] * 8), (403, [1e12] * 8)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    frame = frame.selectExpr("*", "'own' AS _id", "'own' AS score", "'own' AS rank", "'own' AS list")
    want = sorted(plain.top(vectors, lambda i: i % 50 == 0), key=repr)
    assert got(topk.top_k(frame, "vec_id % 50 = 0"), "query_id", "rank", "vec_id", "score") == want
    for name, value in (("QUERY_ROWS", 3), ("SHARD_ROWS", 9), ("SHARD_STEP", 4), ("FAN_IN", 3)):
        monkeypatch.setattr(topk, name, value)
    again = frame.union(frame.filter("vec_id < 60"))  # repeated rows count once
    assert got(topk.top_k(again, "vec_id % 50 = 0"), "query_id", "rank", "vec_id", "score") == want
    assert topk.top_k(frame.filter("false"), "vec_id % 50 = 0").count() == 0
    few = topk.top_k(frame.filter("vec_id < 3"), "vec_id % 50 = 0")
    assert len(few.collect()) == 2


# 10 -------------------------------------------------------------------------------------------------


def check_copies(rows, found):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = []
    for i, t in rows:
        known = [x for x in groups[t or ""] if x is not None]
        want.append((i, max(known) if known else None, len(groups[t or ""])))
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=repr) == sorted(want, key=repr)
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_dedup(spark, odd, empty, monkeypatch):
    check_copies([(i, t) for i, t, _ in ROWS], exact_dedup.exact_dedup(odd).collect())
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns and {r["_digest"] for r in kept.collect()} == {"own"}
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t, _ in ROWS})
    # same length and prefix, marks that run together, groups of all sizes
    rows = [(i, "p" * 300 + str(i % 7)) for i in range(300)] + [(300 + i, "short") for i in range(200)]
    monkeypatch.setattr(exact_dedup, "MARKS", 3)
    monkeypatch.setattr(common, "HOT_SHARE", 5)
    check_copies(rows, exact_dedup.exact_dedup(texts(spark, rows)).collect())


def test_exact_dedup_is_native(spark):
    for query in (exact_dedup.op10_exact_dedup, mixing.op5_mixing):
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_schemas(spark):
    from siftgate.llm import registry

    assert sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_secrets", "op2_packing", "op3_simhash", "op4_sharding", "op5_mixing",
        "op6_toxicity", "op7_passages", "op8_suffixes", "op9_topk", "op10_exact_dedup",
        "op11_language", "op12_alignment", "op13_conversations",
    ]
    assert T.LongType() == sharding.op4_sharding(spark, SF_DIR).schema["slot"].dataType
