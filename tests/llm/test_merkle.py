"""op13 against a literal tree whose roots are hashed anew for each row."""

import random
import zlib
from hashlib import sha256

import pytest
from retail_insight.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, digest string, n long"


def h(values):
    return sha256("".join(values).encode()).hexdigest()


def leaf(doc, text, lang, source, n_chars):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n_chars, text))


def level(digests):
    return [h(digests[i:i + 8]) for i in range(0, len(digests), 8)]


def path(digests, at):
    """(the one digest left, [(before, after)] from the place ``at`` up)."""
    out = []
    while len(digests) > 1:
        lo = at // 8 * 8
        out.append((digests[lo:at], digests[at + 1:lo + 8]))
        digests, at = level(digests), at // 8
    return digests[0], out


def literal(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, leaf(*r)))
    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for t in trees.values():
        t.sort(key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[1]))
    subroots = [path([d for _, d in trees[v]], 0)[0] for v in order]
    out = []
    for k, v in enumerate(order):
        digests = [d for _, d in trees[v]]
        for at, (r, d) in enumerate(trees[v]):
            _, low = path(digests, at)
            root, high = path(subroots, k)
            doc, text = r[0], r[1]
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(doc, text, *r[2:])
            for before, after in low + high:
                folded = h([*before, folded, *after])
            proof = h(s for before, after in low + high for s in before + after)
            out.append((doc, d, subroots[k], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def table(seed, n, langs):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "Abc É", "lower", "Ünï 日本", f"Text {i}"])
        rows.append((rng.choice([i, i, i, None, -i]), text, rng.choice(langs), rng.choice([None, "s", ""]),
                     rng.choice([None, i])))
    return rows + rows[:5]


@pytest.mark.parametrize("n,langs,height", [(1, [None], 4), (8, ["en"], 4), (9, ["en"], 4), (700, ["en", None, "", "é", "z"], 4),
                                            (700, ["en", None, "", "é", "z"], 1), (150, [f"l{i}" for i in range(70)], 1)])
def test_manifest_is_the_literal_tree(spark, monkeypatch, n, langs, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = table(n, n, langs)
    if n <= 9:
        rows = rows[:n]
    out = merkle.manifest(spark.createDataFrame([(*r, "x", 1, "x", 1) for r in rows], SCHEMA),
                          changed=merkle.lower_case_some())
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == literal(rows)


def test_empty_table_and_very_long_text(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), changed=merkle.lower_case_some()).count() == 0
    rows = [(i, "Long " * 200_000, "en", "s", 1) for i in range(3)]
    out = merkle.manifest(spark.createDataFrame([(*r, "x", 1, "x", 1) for r in rows], SCHEMA),
                          changed=merkle.lower_case_some())
    assert sorted((tuple(r) for r in out.collect()), key=repr) == literal(rows)


def test_a_fold_resumes_and_hashes_right_siblings_only():
    parent = merkle.Parent(b"".join(sha256(bytes([i])).hexdigest().encode() for i in range(5)))
    new = b"f" * 64
    for slot in range(5):
        before, after = parent.siblings(slot)
        assert parent.fold(slot, new) == sha256(before + new + after).hexdigest().encode()
