"""Groups of the Jaccard join: whole components when clusters are split, and work in proportion to the rows of a cluster."""

import random

from stayline.llm import jaccard


def drifting(rng, number, length, steps, far):
    """Texts that each change ``steps`` words of the one before (``far``) or of the first."""
    last = [f"w{rng.randint(0, 10**6)}" for _ in range(length)]
    out = [" ".join(last)]
    for _ in range(number - 1):
        own = list(last)
        for _ in range(steps):
            own[rng.randrange(length)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
        if far:
            last = own
    return out


def brute(rows, words, percent):
    sets = {i: set(jaccard.shingle_set(t, words).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def classes_of(docs, words, percent):
    signed = jaccard._written(jaccard.signatures(docs, words, percent, jaccard.sketch(docs, words)), "signed")
    return signed.selectExpr("doc_id as rep", "size", "prefix")


def test_split_groups_lose_no_link(documents):
    rng = random.Random(8)
    texts = drifting(rng, 40, 120, 3, True) + drifting(rng, 40, 120, 2, False) + drifting(rng, 12, 60, 2, True) + drifting(rng, 12, 60, 4, False)
    common = " ".join(f"c{i}" for i in range(30))  # a passage that ties all prefixes together
    texts += [f"{common} {t}" for t in drifting(rng, 12, 20, 1, False) + drifting(rng, 12, 20, 1, True)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = documents(rows)
    found = {r.id: r.root for r in jaccard.connected(docs, classes_of(docs, 5, 80), 5, 80, group_rows=4).collect()}
    want = brute(rows, 5, 80)
    assert {i: found.get(i, i) for i, _ in rows} == want
    assert 5 < len(set(want.values())) < 100


def test_work_grows_with_the_rows_of_one_cluster(documents, monkeypatch):
    plain, seen = jaccard._written, {}

    def counted(df, name):
        out = plain(df, name)
        if name in ("qualified", "pairs"):
            seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "_written", counted)
    rng = random.Random(3)
    work = []
    for number in (200, 400):
        docs = documents(list(enumerate(drifting(rng, number, 200, 3, False))))
        classes = classes_of(docs, 5, 80)
        seen.clear()
        assert {r.root for r in jaccard.connected(docs, classes, 5, 80, group_rows=16).collect()} == {0}
        work.append(seen["qualified"] + seen["pairs"])
    assert work[0] <= 1.5 * 200 and work[1] <= 2.5 * work[0]


def test_empty_and_single(documents):
    for rows in ([], [(1, None)], [(1, "a b c d e f g h i j")]):
        docs = documents(rows)
        assert [tuple(r) for r in jaccard.join(docs).collect()] == [(i, 6 if t else 0, i) for i, t in rows]
