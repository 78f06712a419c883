"""Python tasks of the pipeline hand free memory back."""

import gc
import weakref

import pytest

from chartfold.llm import common


class Held:
    pass


def test_memory_is_handed_back_before_and_after_the_batches(monkeypatch):
    seen, held = [], []
    monkeypatch.setattr(common, "release", lambda: seen.append([h() is not None for h in held]))

    def work(batches):
        own = Held()
        held.append(weakref.ref(own))
        seen.append("first")
        for b in batches:
            yield b + 1

    assert list(common.released(work, iter([1, 2]))) == [2, 3]
    gc.collect()
    # What the task held itself is free when its memory is handed back.
    assert seen == [[], "first", [False]]


def test_a_task_that_fails_still_fails():
    def work(batches):
        yield next(batches)
        raise ValueError("broken")

    found = common.released(work, iter([1]))
    assert next(found) == 1
    with pytest.raises(ValueError):
        next(found)
