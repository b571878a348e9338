"""The garbage collector rests while texts are encoded, and only then."""

import gc

import pytest

from telhado.llm.tokenfiles import no_collection


def test_collector_rests_and_comes_back():
    assert gc.isenabled()
    before = sum(s["collections"] for s in gc.get_stats())
    with no_collection():
        held = [(str(i), str(i + 1)) for i in range(100_000)]
        assert sum(s["collections"] for s in gc.get_stats()) == before
    assert held and gc.isenabled()
    with pytest.raises(ValueError), no_collection():
        raise ValueError
    assert gc.isenabled()
    gc.disable()
    try:
        with no_collection():
            pass
        assert not gc.isenabled()
    finally:
        gc.enable()
