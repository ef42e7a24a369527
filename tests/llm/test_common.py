import pyarrow as pa
import pytest

from labharm.llm import common


@pytest.mark.parametrize("step", [1, 40, 10**6])
def test_words_of_slices(monkeypatch, step):
    monkeypatch.setattr(common, "STEP_BYTES", step)
    texts = [None, "", " ", "ÀB  c\t", "\x0bx y\r\n", "ÉÈ é", "z" * 100, "a\x1cb\u00a0c d"] * 3
    array = pa.array(texts)
    for a, z in common.steps(array):
        begin, code, vocabulary = common.words(array[a:z])
        got = [[vocabulary[c].as_py() for c in code[i:j]] for i, j in zip(begin, begin[1:])]
        assert got == [[w.decode() for w in (t or "").encode().lower().split()] for t in texts[a:z]]
    assert [r for a, z in common.steps(array) for r in range(a, z)] == list(range(len(texts)))


def test_shingles_of_short_and_long_texts():
    begin, code, vocabulary = common.words(pa.array(["a b c d", "", "a b", "b c d e a", "a b"]))
    got, made = common.shingles(begin, common.hashes(vocabulary)[code], 3)
    assert made.tolist() == [2, 0, 1, 3, 1]
    assert got[2] == got[6] and got[1] == got[3] and len(set(got.tolist())) == 5


def test_operators_keep_nothing_in_others_tasks():
    """A worker that goes on to another operator's task lets go of what the one before kept; tasks of its own find it again."""
    import pyarrow as pa

    from labharm.llm import common, decontaminate, token_tables

    texts = pa.array(["some words", None, "of no weight"])
    decontaminate.plain_words(texts)
    token_tables._cache["x", 2] = token_tables.Known("<u2")
    assert list(common.steps(texts, operator="decontaminate")) == [(0, 3)]
    assert decontaminate._hashes and not token_tables._cache
    token_tables._cache["x", 2] = token_tables.Known("<u2")
    assert list(common.steps(texts, 12, "token_tables")) == [(0, 2), (2, 3)]
    assert token_tables._cache and not decontaminate._hashes
    assert list(common.steps(texts)) == [(0, 3)]
    assert not token_tables._cache


def test_known_words_over_many_runs():
    import numpy as np

    from labharm.llm.token_tables import Known

    rng = np.random.default_rng(2)
    known, digests = Known("<u2"), rng.integers(2**63, size=(5000, 2)).astype(np.uint64)
    sizes = rng.integers(1, 5, 5000)
    ids, ends = rng.integers(60_000, size=sizes.sum()).astype("<u2"), np.concatenate([[0], np.cumsum(sizes)])
    for a in range(0, 5000, 170):
        z = min(5000, a + 170)
        known.add(digests[a:z], ids[ends[a] : ends[z]], sizes[a:z])
    assert all(len(x[0]) >= 2 * len(y[0]) for x, y in zip(known.runs, known.runs[1:]))
    at, n = known.find(digests)
    assert (n == sizes).all() and all((known.ids[i : i + k] == ids[a:z]).all() for i, k, a, z in zip(at, n, ends, ends[1:]))
    assert sum(x.nbytes for run in known.runs for x in run) == 24 * 5000
