"""A unit's stream state costs one read and one write a micro-batch."""

from pyspark.sql import types as T

from wearlog.streaming.scoring import PackedBuffer, UnitBuffer


class Store:
    """One unit's value state that counts its requests."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_a_unit_is_read_and_written_once_a_batch():
    store = Store()
    buffer = PackedBuffer(["u"], "cycle", "arrival", T.LongType(), ["s"], 5, None)
    buffer.init(store)
    frame = lambda cycles, arrival: [{"u": 7, "cycle": c, "arrival": arrival, "s": None if c == 4 else c + arrival / 10} for c in cycles]
    first = list(buffer.handleInputRows((7,), iter(frame(range(1, 9), 1)), None))
    assert [r.cycle for r in first] == [4, 5, 6, 7, 8] and [r._whole for r in first] == [False] * 4 + [True] and store.calls == 2
    # two late rows, an older arrival, a newer one
    second = list(buffer.handleInputRows((7,), iter(frame([1, 2, 6], 2) + frame([8], 0)), None))
    assert store.calls == 4 and [r._late_rows for r in second] == [None] * 5 + [2]
    assert [r.s for r in second] == [None, 5.1, 6.2, 7.1, 8.1, None]
    assert issubclass(PackedBuffer, UnitBuffer)
