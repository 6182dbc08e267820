from concurrent.futures import ThreadPoolExecutor

from quire.operators import claims
from quire.operators.claims import claim_pages, claim_state, finish_pages, with_claims
from quire.operators.crawl import frontier, pending_pages
from quire.session import work_path
from quire.sinks.commit_log import append_entry, read_entries
from quire.sinks.index_store import _commit, current_version


def pages(df):
    return sorted(r["page"] for r in df.collect())


def test_a_page_is_handed_out_once_and_again_after_its_lease(spark):
    front, log = frontier(spark, 0, 90, 10), work_path(spark, "t-claims")
    assert pages(claim_pages(front, log, "a", 4, lease=60, now=0)) == [0, 10, 20, 30]
    assert pages(claim_pages(front, log, "b", 4, lease=60, now=10)) == [40, 50, 60, 70]
    assert pages(claim_pages(front, log, "c", 4, lease=5, now=20)) == [80, 90]
    assert pages(claim_pages(front, log, "d", 4, lease=5, now=21)) == []
    mine = spark.createDataFrame([(0,), (10,), (40,), (999,)], "page INT")
    assert pages(finish_pages(mine, log, "a", now=30)) == [0, 10]            # 40 is b's
    assert pages(finish_pages(mine, log, "a", now=31)) == []                 # finished once
    assert pages(finish_pages(spark.createDataFrame([(20,)], "page INT"), log, "a", now=60)) == []   # lease over
    assert pages(claim_pages(front, log, "d", 9, lease=60, now=60)) == [20, 30, 80, 90]
    marked = {r.page: r.claimed for r in with_claims(front, claim_state(spark, log), now=75).collect()}
    assert [p for p in sorted(marked) if not marked[p]] == [40, 50, 60, 70]
    free = pending_pages(with_claims(front, claim_state(spark, log), now=75), spark.createDataFrame([(50,)], "page INT"))
    assert pages(free) == [40, 60, 70]


def test_processed_claimed_repeated_and_null_pages(spark):
    log = work_path(spark, "t-claims-edge")
    front = spark.createDataFrame([(1, False), (1, False), (2, True), (3, False), (None, False), (4, False)],
                                  "page INT, claimed BOOLEAN")
    got = claim_pages(front, log, "a", 9, 60, processed=spark.createDataFrame([(3,), (None,)], "page INT"), now=0)
    assert [r.page for r in got.orderBy("page").collect()] == [1, 4]
    assert claim_pages(front.limit(0), log, "a", 9, 60, now=0).count() == 0


def test_concurrent_takers_never_share_a_page(spark):
    front, log = frontier(spark, 0, 29, 1), work_path(spark, "t-claims-race")
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda t: pages(claim_pages(front, log, f"t{t}", 5, lease=1e6)), range(6)))
    assert sorted(p for g in got for p in g) == list(range(30))
    assert [n for n, _ in read_entries(spark, f"{log}/log")] == [1, 2, 3, 4, 5, 6]


def test_a_lost_writer_is_never_read_and_state_survives_snapshots(spark, monkeypatch):
    monkeypatch.setattr(claims, "SNAPSHOT_EVERY", 2)
    front, log = frontier(spark, 0, 9, 1), work_path(spark, "t-claims-snap")
    for i in range(6):
        assert pages(claim_pages(front, log, "a", 1, lease=100, now=i)) == [i]
        # a writer that crashed before its entry
        spark.createDataFrame([(9, "z", 1e9, True)], claims.CLAIMS_SCHEMA).write.parquet(f"{log}/data/c-lost{i}")
    whole = [e["whole"] for _, e in read_entries(spark, f"{log}/log")]
    assert whole.count(True) >= 2
    state = claim_state(spark, log)
    assert sorted((r.page, r.until) for r in state.collect()) == [(i, 100.0 + i) for i in range(6)]
    assert state.inputFiles() and len(claims._snapshot(spark, log)[2].inputFiles()) <= 8


def test_one_writer_a_number(spark):
    path = work_path(spark, "t-log")
    assert read_entries(spark, path) == []
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: append_entry(spark, path, 1, {"by": i}), range(8)))
    assert won.count(True) == 1
    assert read_entries(spark, path) == [(1, {"by": won.index(True)})]


def test_saves_at_the_same_time_get_their_own_numbers(spark):
    path = work_path(spark, "t-saves")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: _commit(spark, path, f"v-{i}", 2), range(4)))
    entries = read_entries(spark, f"{path}/commits")
    assert [n for n, _ in entries] == [1, 2, 3, 4]
    assert sorted(e["version"] for _, e in entries) == [f"v-{i}" for i in range(4)]
    assert current_version(spark, path) == {"number": 4, **entries[-1][1]}
