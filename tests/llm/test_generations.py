import random

from vitrine.llm.common import Generations


def test_room_is_kept_and_common_keys_stay():
    rng = random.Random(1)
    cache, misses = Generations(100_000), 0
    for _ in range(300):
        keys = {f"common{k}" for k in range(20)} | {f"rare{rng.randrange(10**9)}" for _ in range(60)}
        new = cache.missing(keys)
        misses += sum(k.startswith("common") for k in new)
        for k in new:
            cache.put(k, k.encode())
        assert all(cache.young[k] == k.encode() for k in keys)
        cache.turn()
        held = [*cache.young.items(), *cache.old.items()]
        assert sum(len(k) + len(v) + Generations.ENTRY for k, v in held) <= 100_000 + 80 * 240
    assert misses == 20


def test_nothing_asked_for_nothing_held():
    cache = Generations(0)
    assert cache.missing([]) == [] and cache.missing(["a"]) == ["a"]
    cache.put("a", b"x")
    cache.turn()
    assert cache.young == {} and cache.old == {"a": b"x"}
