import random

import numpy as np
import xxhash

from riverbend.llm import simhash as S

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
        "\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """(doc_id, fingerprint) -> smallest id reachable over links of at most 4 bits."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if bin(rows[a][1] ^ rows[b][1]).count("1") <= 4:
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted(((i, f"{fp:016x}", low.get(find(k))) for k, (i, fp) in enumerate(rows)), key=str)


def test_fingerprint_matches_brute_force():
    texts = [None, "", " \n\t", "one", "One two", "a b c d", "A B c D e a b c d", "É ß word\x0bword\x0cend\r\n x y z " * 40]
    assert [S.fingerprint(t) % (1 << 64) for t in texts] == [brute_fingerprint(t) for t in texts]


def test_golay_keys_meet_within_two_bits():
    errors = S.golay_errors()
    assert (errors >= 0).all()  # the code is perfect
    rng = random.Random(1)
    x = np.array([rng.getrandbits(23) for _ in range(400)], np.int64)
    kx, fx = S.golay_keys(x, errors)
    assert set(fx.sum(axis=1)) <= {1, 6}
    for flips in (0, 1, 2):
        y = x.copy()
        for k in range(len(y)):
            for b in rng.sample(range(23), flips):
                y[k] ^= 1 << b
        ky, fy = S.golay_keys(y, errors)
        assert all(set(a[m]) & set(b[n]) for a, m, b, n in zip(kx, fx, ky, fy))


def test_keys_meet_for_every_link():
    errors, rng = S.golay_errors(), random.Random(2)
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        ka, kb = (set(S.keyed(np.array([v], np.uint64).view(np.int64), errors)[0].tolist()) for v in (a, b))
        assert ka & kb


def _planted(rng, n, centres):
    out = []
    for k in range(n):
        fp = centres[k % len(centres)]
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            fp ^= 1 << bit
        out.append(fp)
    return out


def test_components_with_split_buckets(spark):
    """Dense clusters whose buckets exceed the bound go through pairs of blocks: same links."""
    rng = random.Random(3)
    fps = sorted(set(_planted(rng, 300, [rng.getrandbits(64) for _ in range(3)])) | {rng.getrandbits(64) for _ in range(50)})
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    want = {}
    for _, f, c in brute_components(list(enumerate(fps))):
        want.setdefault(c, set()).add(int(f, 16))
    for bound in (4096, 8):
        found = {r["node"]: r["root"] for r in S.components(S.similar(df, 4, bound)).collect()}
        groups = {}
        for x, fp in zip(signed, fps):
            groups.setdefault(found.get(x, x), set()).add(fp)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates_edge_cases(docs, clashing):
    long = " ".join(f"w{k % 700}" for k in range(30_000))
    rows = [(5, "the quick brown fox jumps"), (3, "The QUICK brown fox jumps"), (9, None), (8, ""), (None, "\n"),
            (7, "other words stand here now"), (7, "other words stand here now"), (None, "alone with no id at all"),
            (1, long), (2, long + " tail")]
    got = sorted((tuple(r) for r in S.near_duplicates(docs(rows, **clashing)).collect()), key=str)
    want = brute_components([(i, brute_fingerprint(t)) for i, t in rows])
    assert got == want


def test_keep_one(docs, clashing):
    rows = [(5, "the quick brown fox jumps"), (3, "The QUICK brown fox jumps"), (3, "The QUICK brown fox jumps"),
            (9, None), (8, ""), (None, "alone with no id at all"), (None, "alone with no id at all")]
    df = docs(rows, **clashing)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == [
        (3, "The QUICK brown fox jumps"), (8, ""), (None, "alone with no id at all")]


def test_empty_table(docs):
    assert S.near_duplicates(docs([])).collect() == []
    assert S.keep_one(docs([])).collect() == []


def test_query_against_brute_force(spark):
    from riverbend.llm.queries import op3_simhash_near_dedup
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op3_simhash_near_dedup(spark, SF).collect()), key=str)
    assert got == brute_components(rows)
