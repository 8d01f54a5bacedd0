"""State of a keyed processor in memory, which counts what is read and written, under a driven clock."""

import collections


class _Value:
    def __init__(self, counts):
        self.row, self.counts = None, counts

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


class _Map:
    def __init__(self, counts):
        self.rows, self.counts = {}, counts

    def containsKey(self, key):
        return tuple(key) in self.rows

    def getValue(self, key):
        value = self.rows[tuple(key)]
        self.counts["read"] += _size(value)
        return value

    def updateValue(self, key, value):
        self.counts["written"] += _size(value)
        self.rows[tuple(key)] = value

    def removeKey(self, key):
        self.rows.pop(tuple(key), None)

    def iterator(self):
        return iter(list(self.rows.items()))

    def clear(self):
        self.rows.clear()


class _List:
    def __init__(self, counts):
        self.rows, self.counts = [], counts

    def get(self):
        return iter(self.rows)

    def appendList(self, rows):
        self.rows.extend(rows)

    def clear(self):
        self.rows = []


def _size(value):
    return len(value[0]) if value and isinstance(value[0], list) else 1


class Clock:
    """Watermark and processing time, as a test sets them."""

    def __init__(self):
        self.watermark = self.now = 0

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def getCurrentProcessingTimeInMs(self):
        return self.now


class _Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


class Handle:
    """One key's state. ``step`` does what a micro-batch does: rows first, then the timers that are due."""

    def __init__(self, processor, key=("X",)):
        self.counts = collections.Counter()
        self.timers, self.processor, self.key, self.clock = set(), processor, key, Clock()
        processor.init(self)

    def getValueState(self, name, schema, ttl=None):
        return _Value(self.counts)

    def getMapState(self, name, key, value, ttl=None):
        return _Map(self.counts)

    def getListState(self, name, schema, ttl=None):
        return _List(self.counts)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def step(self, rows=None, watermark=None, now=None):
        self.clock.watermark = self.clock.watermark if watermark is None else watermark
        self.clock.now = self.clock.now if now is None else now
        out = list(self.processor.handleInputRows(self.key, iter([rows]), self.clock)) if rows is not None else []
        upto = self.clock.watermark if now is None else self.clock.now
        for at in sorted(t for t in self.timers if t < upto):
            self.timers.discard(at)
            out += self.processor.handleExpiredTimer(self.key, self.clock, _Expired(at))
        return out
