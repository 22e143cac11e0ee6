import hashlib
import re
import uuid

from riskgrid.llm.line_dedup import LineRuns, dedup_lines, key_rows
from riskgrid.session import ensure_checkpoint_dir

STRIP = "[\x20\x09-\x0d]*"


def folder(spark):
    return f"{ensure_checkpoint_dir(spark)}/lines-test/{uuid.uuid4().hex}"


def key(line):
    s = re.fullmatch(f"{STRIP}(.*?){STRIP}", line, re.S)[1]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s) if len(s) >= 40 else None


def brute(rows):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if key(line):
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(holders[key(x)]) >= 5
                                         and i != max((h for h in holders[key(x)] if h is not None), default=None))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


LONG = "A line of forty code points or somewhat more, É"
CASES = ([(i, f"{LONG}\nown line {i}\n \t{LONG.replace('A', 'a')}\r") for i in range(1, 9)]       # folded, stripped, twice in a row
         + [(i, f"four documents hold this line, which is one too few {'' if i < 14 else 'x'}") for i in range(10, 15)]
         + [(20, None), (21, ""), (22, "\n\n"), (23, LONG.replace("É", "é")), (8, LONG), (None, LONG), (None, f"{LONG}\nx"),
            (24, "x" * 39 + "\n" + "x" * 39), (25, "ß" * 40), (26, "ß" * 40)]
         + [(i, "s" * 40 + "\n" + "t" * 39) for i in range(30, 60)]                                # settled in the first batch
         + [(i, "\n".join(f"line {j} of a text that some others share in whole" for j in range(i % 7, 400))) for i in range(60, 75)]
         + [(99, "w" * 1_000_000 + "\n" + "s" * 40)])


def digest(frame):
    return sorted(((r[0], r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in frame.collect()), key=str)


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in CASES], "doc_id bigint, text string, key string, batch string, docs int")
    for batches, fanout in ((1, 4), (6, 2), (9, 3)):
        assert digest(dedup_lines(docs, folder(spark), batches=batches, fanout=fanout)) == brute(CASES)
    assert dedup_lines(docs.limit(0), folder(spark)).count() == 0


def test_runs(spark):
    docs = spark.createDataFrame([(100 - i, f"{'s' * 40}\n{'u' * 40}{i}") for i in range(60)], "doc_id bigint, text string")
    at = folder(spark)
    runs = LineRuns(spark, at, docs.schema["doc_id"].dataType, fanout=3)
    parts = [key_rows(docs.filter(f"doc_id > {90 - 10 * b} and doc_id <= {100 - 10 * b}"), "doc_id", "text", 40) for b in range(6)]
    for b in (0, 1):
        runs.add(parts[b], b)
    own = [runs.table(r).count() for r in runs.runs()]
    assert own == [11, 10]  # the second batch's shared line was settled by the first, so it is not written again
    plan = runs.table(runs.runs()[0]).groupBy("key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # runs are bucketed by key
    runs.add(parts[2], 2)
    assert [(r.level, r.first, r.last) for r in runs.runs()] == [(1, 0, 2)]
    # another session object goes on from the folder; what is there is not added twice
    again = LineRuns(spark, at, docs.schema["doc_id"].dataType, fanout=3)
    for b in range(6):
        again.add(parts[b], b)
    assert [(r.level, r.first, r.last) for r in again.runs()] == [(1, 0, 2), (1, 3, 5)]
    got = again.repeated().collect()
    assert len(got) == 1 and got[0].top == 100 and got[0].docs >= 5
    # an unfinished run is not one
    again.fs.delete(again.path(again.runs()[1].path + "/_SUCCESS"), False)
    assert [(r.level, r.first, r.last) for r in again.runs()] == [(1, 0, 2)]
