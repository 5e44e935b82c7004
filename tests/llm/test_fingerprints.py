import hashlib
import random

import pytest

from certflow.llm.fingerprints import MinHash, digest, edited_likeness, fingerprints, jaccard, likeness, matches

SCHEMA = "doc_id long, text string, place string, kind string, digest string, match_id string, n_chars string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "p", "k", "d", "m", "n") for i, t in rows], SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioußédrtnsl") for _ in range(rng.randint(2, 9))) for _ in range(n))


def rows():
    base = prose(1, 300)
    made = [(k, prose(k + 10, 40)) for k in range(40)]
    made += [(100, base), (101, base), (102, base[:-30] + "another end of the text"), (103, "x " + base), (104, None), (105, ""), (106, "a"),
             (107, "abcd"), (108, "\U0001f600é" * 5), (109, base[:200]), (-5, prose(99, 3)), (50, " \n\t")]
    return made


def brute(rows):
    minhash = MinHash()
    keyed = sorted({(i is None, i or 0, digest(t), t or "") for i, t in rows})
    made = {}
    for k, (no_id, i, d, t) in enumerate(keyed):
        after = keyed[(k + 1) % len(keyed)][3]
        quarter = len(t) // 4
        edited = t[:len(t) - quarter] + after[:quarter]
        own, other, following = map(minhash.whole, (t, edited, after))
        made[None if no_id else i, t] = (len(t), hashlib.sha256(edited.encode()).hexdigest(),
                                         likeness(own, other), likeness(own, following))
    return sorted([(i, *made[i, t or ""]) for i, t in rows], key=str)


def found(spark, rows, **args):
    made = edited_likeness(frame(spark, rows).repartition(4), **args)
    assert made.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "match_id"]
    return made.collect()


def checked(got):
    return sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got], key=str)


def test_equals_brute_force(spark, monkeypatch):
    assert checked(found(spark, rows())) == brute(rows())
    from certflow.llm import fingerprints as module

    monkeypatch.setattr(module, "PLACE_CHARS", 1000)  # many ranges, as with large tables
    assert checked(found(spark, rows())) == brute(rows())


def test_repeated_and_null_ids(spark):
    more = rows() + [(None, "no id at all, one"), (None, "no id at all, two"), (None, None), (3, "other text of an id"), (3, "other text of an id"), (100, rows()[40][1])]
    assert checked(found(spark, more)) == brute(more)


def test_matches(spark):
    got = {r.doc_id: r.match_id for r in matches(frame(spark, rows())).collect()}
    own = {i for i in got if i not in (101, 102, 103, 105)}
    assert {i: m for i, m in got.items() if i in own} == {i: i for i in own}
    assert [got[i] for i in (101, 102, 103, 105)] == [100, 100, 100, 104]


def test_hot_group_and_recall(spark):
    base = prose(7, 400).split(" ")
    rng = random.Random(3)
    near = []
    for k in range(300):
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = prose(k + 1000, 1)
        near.append((k, " ".join(words)))
    near += [(k, near[0][1]) for k in range(1000, 1300)]
    truth = [jaccard(MinHash(), near[0][1], t) >= 0.8 for _, t in near]
    got = {r.doc_id: r.match_id for r in matches(frame(spark, near).repartition(8)).collect()}
    assert sum(truth) > 400
    assert sum(got[i] == 0 for (i, _), t in zip(near, truth) if t) >= 0.99 * sum(truth)
    assert all(m == i or jaccard(MinHash(), dict(near)[i], dict(near)[m]) >= 0.8 for i, m in got.items())


def test_likeness_is_the_similarity():
    minhash, one = MinHash(hashes=1024), prose(1, 500)
    for cut in (0, 100, 900, 2000):
        two = one[cut:] + prose(2, 100)
        assert abs(likeness(minhash.whole(one), minhash.whole(two)) - jaccard(minhash, one, two)) < 0.06


def test_fingerprints(spark):
    got = {r.doc_id: r for r in fingerprints(frame(spark, rows())).collect()}
    assert got[100].fingerprint == got[101].fingerprint != got[102].fingerprint and got[104].fingerprint == got[105].fingerprint
    assert (got[104].n_chars, got[108].n_chars, len(got[106].fingerprint)) == (0, 10, 512)


@pytest.mark.parametrize("table", [[], [(1, "only one document, which follows itself")], [(1, None)], [(None, None)] * 3])
def test_small_tables(spark, table):
    assert checked(found(spark, table)) == brute(table)


def test_long_text(spark):
    table = [(1, prose(1, 250_000)), (2, prose(2, 10))]
    assert len(table[0][1]) > 1 << 20
    assert checked(found(spark, table)) == brute(table)
