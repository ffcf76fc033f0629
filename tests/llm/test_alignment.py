"""Two tokenizers' tokens against a plain version, document by document."""

import collections
import hashlib

import conftest as odd_data
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from siftgate.llm import alignment, common

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_letters():
    """The letters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_groups(text, sides):
    """``[(a ids, b ids), ..]``"""
    if not text:
        return []
    a, b = sides
    letters = byte_letters()
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if any(b"".join(t for _, t in side) != want for side in (left, right)):
        return []

    def ends(side):
        at, out = 0, {}
        for i, t in side:
            at += len(t)
            out[at] = i
        return out

    left, right = ends(left), ends(right)
    groups, now = [], ([], [])
    for end in sorted(left.keys() | right.keys()):
        for ids, found in zip(now, (left, right)):
            ids += [found[end]] if end in found else []
        if end in left and end in right:
            groups.append(now)
            now = ([], [])
    return groups


def plain(rows, sides):
    groups = [(i, plain_groups(t, sides)) for i, t in rows]
    links = [(i, g, collections.Counter((a, b) for left, right in g for a in left for b in right)) for i, g in groups]
    held = collections.Counter(p for _, _, found in links for p in found)
    best = collections.defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for i, g, found in links:
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        hashed = hashlib.sha256(text.encode()).hexdigest() if g else ""
        n_best = sum(n for p, n in found.items() if held[p] == best[p[0]])
        total = sum(n * held[p] for p, n in found.items())
        out.append((i, sum(len(x) for x, _ in g), sum(len(x) for _, x in g), len(g), sum(found.values()), n_best, total, hashed))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


SPECIAL = [
    (20, "<|endoftext|> and <s> </s> <unk> <0x41>"),
    (21, "  two  blanks \n\n tabs\t\tend "),
    (22, "▁ stands for a blank"),
    (23, "日本語のテキスト 한국어 ภาษาไทย 🙂🙃 à ﬁ ½"),
    (24, "a\x00b\x01c"),
    (25, " "),
    (26, "-" * 300 + "=" * 77 + "0" * 100),
    (27, "qwxzkvjq" * 400),
    (28, "é" * 501),
    (29, "don't I'll we've THEY'RE 12345678901234567890"),
]


def test_odd_rows(spark, odd, sides, monkeypatch):
    rows = [(i, t) for i, t, _ in odd_data.odd_rows()]
    more = spark.createDataFrame(SPECIAL, "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    assert got(alignment.align_documents(docs)) == plain([*rows, *SPECIAL], sides)


def test_empty_table(empty):
    assert alignment.align_documents(empty).count() == 0


def test_groups_as_text(spark, sides):
    docs = spark.createDataFrame(SPECIAL, "doc_id long, text string")
    for row in alignment.token_groups(docs).collect():
        want = plain_groups(dict(SPECIAL)[row.doc_id], sides)
        assert row.groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)


def test_wide_groups_are_counted_by_id(sides):
    tables = alignment.coders(alignment.Vocabularies())
    a = [[tables.a_bytes.index(b"a")] * 30 + [tables.a_bytes.index(b"b")] * 2, [tables.a_bytes.index(b"a")] * 3]
    b_of = tables.b_bytes.index
    b = [[b_of(b"aa")] * 14 + [b_of(b"a")] * 2 + [b_of(b"b")] * 2, [b_of(b"aa"), b_of(b"a")]]
    found = alignment.align(a, b, tables)
    doc, pair, links = alignment.linked_pairs(found)
    # made wide: all tokens of each document in one group
    found.a_group, found.b_group = found.a["doc"].to_numpy().astype("int64"), found.b["doc"].to_numpy().astype("int64")
    found.groups = 2
    del found.group_doc
    doc, pair, links = alignment.linked_pairs(found)
    want = collections.Counter((d, x << alignment.B_BITS | y) for d in (0, 1) for x in a[d] for y in b[d])
    assert dict(zip(zip(doc.tolist(), pair.tolist()), links.tolist())) == want


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_table(spark, sf_dir, sides):
    rows = [(r.doc_id, r.text) for r in common.table(spark, sf_dir, "documents").collect()]
    assert got(alignment.op12_alignment(spark, sf_dir)) == plain(rows, sides)
