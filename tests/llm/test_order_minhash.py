from __future__ import annotations

import hashlib

import regex
import xxhash

from strandline.llm import order_minhash as om
from tests.llm.helpers import bag, documents, rows

SYMBOL = regex.compile(r"[[\p{L}\p{M}\p{N}]--[\U00002E80-\U0010FFFF]]{1,12}|[^ \t\n\r\f\x0B]", regex.V1)


def signed(n: int) -> int:
    return n - 2**64 if n >= 2**63 else n


def hash_longs(*values: int) -> int:
    """xxhash64 over several numbers: the hash of one is the seed of the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), seed)
    return seed


def hash_long_int(value: int, small: int) -> int:
    seed = hash_longs(value)
    return xxhash.xxh64_intdigest(small.to_bytes(4, "little"), seed)


def brute(text: str) -> list[int | None]:
    """A signature by its definition: number the k-mers, take the few that follow the
    start of each bin on the circle of hashes, and hash them in text order."""
    symbols = [xxhash.xxh64_intdigest(s.encode(), 42) for s in SYMBOL.findall(text)]
    n = max(len(symbols) - om.K + 1, min(len(symbols), 1))
    kmers = [hash_longs(*(symbols[i : i + om.K] + [0] * om.K)[: om.K]) for i in range(n)]
    seen: dict[int, int] = {}
    values: list[tuple[int, int]] = []
    kept_bits = 64 - om.HASH_BITS
    for at, kmer in enumerate(kmers):
        # Occurrences are told apart by the bits that a packed number keeps.
        short = (kmer >> kept_bits)
        k = seen[short] = seen.get(short, -1) + 1
        value = hash_long_int(kmer, k) >> kept_bits & (1 << om.HASH_BITS) - 1
        values.append((value, at))
    out: list[int | None] = [None] * om.BINS
    if not values:
        return out
    whole = 1 << om.HASH_BITS
    for b in range(om.BINS):
        start = b << om.HASH_BITS - 6
        near = sorted(((value - start) % whole, at) for value, at in values)[: om.SELECTED]
        out[b] = hash_longs(*(kmers[p] for p in sorted(at for _, at in near))) & 0xFFFFFFFF
    return out


def show(signature: list[int | None]) -> str:
    return "".join("-" * 8 if x is None else f"{x:08x}" for x in signature)


def like(a: list, b: list) -> float:
    filled = sum(x is not None or y is not None for x, y in zip(a, b))
    equal = sum(x is not None and x == y for x, y in zip(a, b))
    return equal / filled if filled else 1.0


def test_fingerprints_equal_brute_force(spark):
    """The packed sort key keeps 35 bits of signed hashes, of which the sign is gone;
    the brute force keeps the same bits."""
    data = [r for r in rows(40) if r[0] is not None]
    unique = list({r[0]: r for r in data}.values())
    docs = documents(spark, unique)
    found = {r["doc_id"]: r for r in om.fingerprints(docs).collect()}
    order = sorted(unique, key=lambda r: -r[0])
    following = {a[0]: b for a, b in zip(order, order[1:] + order[:1])}
    assert len(found) == len(unique)
    for doc_id, text, *_ in unique:
        text, after = text or "", following[doc_id][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        mine, changed, other = brute(text), brute(edited), brute(after)
        assert r["fingerprint"] == show(mine)
        assert r["edited_fingerprint"] == show(changed)
        assert abs(r["near_edited"] - like(mine, changed)) < 1e-12
        assert abs(r["near_next"] - like(mine, other)) < 1e-12


def test_repeated_rows_and_null_ids(spark):
    found = bag(om.fingerprints(documents(spark)), "doc_id", "n_chars")
    expected = [(r[0], len(r[1] or "")) for r in rows()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    shuffled = [w for i in range(20) for w in words[i::20]]
    data = [(i, " ".join(t), None, None, None) for i, t in enumerate([words, words, moved, shuffled])]
    found = om.signatures(documents(spark, data), "text", "sig").select("doc_id", "sig").collect()
    sig = {r["doc_id"]: r["sig"] for r in found}
    assert like(sig[0], sig[1]) == 1
    assert 0.3 < like(sig[0], sig[2]) < 1
    assert like(sig[0], sig[3]) < 0.1


def test_order_matters_in_short_texts(spark):
    """Halves swapped: 8 of 12 different k-mers are shared, and a plain likeness of sets
    would be 0.67; of the pairs of k-mers fewer than a fifth keep their order."""
    found = []
    for t in range(30):
        words = [f"t{t}w{i}" for i in range(12)]
        found += [" ".join(words), " ".join(words[6:] + words[:6])]
    data = [(i, text, None, None, None) for i, text in enumerate(found)]
    docs = om.signatures(documents(spark, data), "text", "sig").select("doc_id", "sig")
    sig = {r["doc_id"]: r["sig"] for r in docs.collect()}
    near = [like(sig[i], sig[i + 1]) for i in range(0, len(found), 2)]
    assert sum(near) / len(near) < 0.3
    assert all(None not in s for s in sig.values())


def test_texts_of_few_kmers(spark):
    texts = ["", None, "a", "a b", "a b c", "a b c d", "a a a a a a", "x y z x y z"]
    data = [(i, text, None, None, None) for i, text in enumerate(texts)]
    docs = om.signatures(documents(spark, data), "text", "sig").select("doc_id", "sig")
    sig = {r["doc_id"]: r["sig"] for r in docs.collect()}
    for i, text in enumerate(texts):
        assert sig[i] == brute(text or "")


def test_one_row_and_none(spark):
    one = om.fingerprints(documents(spark, [(7, "abcd efgh", None, None, None)])).first()
    assert one["near_next"] == 1.0
    assert one["edited_sha256"] == hashlib.sha256(b"abcd abcd").hexdigest()
    assert om.fingerprints(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = om.fingerprints(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
