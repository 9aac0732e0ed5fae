from __future__ import annotations

import pytest

from tidemark.sources.delta import DeltaLog


class Recorder:
    """Stands in for a session that has the format; notes what is asked of it."""

    def __init__(self):
        self.asked = {}
        self.read = self

    def format(self, name):
        self.asked = {"format": name}
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def load(self, path):
        return {**self.asked, "path": path}


def test_what_is_asked_of_the_format():
    log = DeltaLog(Recorder(), "/t", ("id",))
    feed = {"format": "delta", "readChangeFeed": "true", "path": "/t"}
    assert log.changes(3, 7) == {**feed, "startingVersion": 3, "endingVersion": 7}
    assert log.snapshot(2) == {"format": "delta", "versionAsOf": 2, "path": "/t"}


def test_without_the_format_spark_says_so(spark, folder):
    log = DeltaLog(spark, folder, ("id",))
    assert not log.exists()
    with pytest.raises(Exception, match="delta"):
        log.snapshot(0)
