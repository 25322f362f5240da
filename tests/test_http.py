import pytest

from tidemark.sources.http import Client, PoliteSource, Refused, Transient


class Net:
    def __init__(self, *answers):
        self.answers, self.asked, self.now, self.slept = list(answers), [], 0.0, []

    def open(self, url, headers, timeout):
        self.asked.append((url, headers))
        status, body = self.answers.pop(0)
        if status is None:
            raise OSError("reset")
        return status, body

    def sleep(self, s):
        self.slept.append(s)
        self.now += s

    def client(self, **kw):
        return Client("tests me@example.org", open_url=self.open, clock=lambda: self.now, sleep=self.sleep, **kw)


def test_needs_an_agent():
    with pytest.raises(ValueError):
        Client(" ")


def test_retries_then_answers():
    net = Net((503, b""), (None, b""), (200, b"x"))
    assert net.client().get("u") == b"x" and len(net.asked) == 3
    assert net.slept[-1] >= 1 or any(s >= 2 for s in net.slept)


def test_refusal_stops_at_once():
    net = Net((403, b""), (200, b"x"))
    with pytest.raises(Refused):
        net.client().get("u")
    assert len(net.asked) == 1


def test_missing_and_exhausted():
    assert Net((404, b"")).client().get("u", missing_ok=True) is None
    with pytest.raises(RuntimeError):
        Net((404, b"")).client().get("u")
    with pytest.raises(Transient):
        Net(*[(429, b"")] * 4).client().get("u")


def test_fixed_distance():
    net = Net((200, b""), (200, b""), (200, b""))
    c = net.client(per_second=2)
    for _ in range(3):
        c.get("u")
    assert net.now == pytest.approx(1.0)


def test_cache_by_range(tmp_path):
    net = Net((206, b"head"), (200, b"all"))
    c = net.client(cache=str(tmp_path))
    assert c.get("u", "0-3") == c.get("u", "0-3") == b"head" and c.get("u") == b"all" and len(net.asked) == 2
    assert net.asked[0][1]["Range"] == "bytes=0-3"


def test_json_and_probe():
    assert Net((200, b'{"a": 1}')).client().get_json("u") == {"a": 1}
    with pytest.raises(RuntimeError):
        Net((200, b"<html>")).client().get_json("u")
    assert not Net((403, b"")).client().reachable("u") and Net((200, b"x")).client().reachable("u")


def test_source_is_one_partition():
    r = PoliteSource({"urls": "[]", "agent": "a"}).reader(None)
    assert len(r.partitions()) == 1 and list(r.read(r.partitions()[0])) == []
