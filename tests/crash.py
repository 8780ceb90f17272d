"""Kill a run again and again, then let it finish: every row must be there exactly once.

Run by hand: ``python tests/crash.py``. The child process ingests landing files one per
micro-batch, promotes them to three refined tables, and is killed at growing ages.
"""

from __future__ import annotations

import json
import subprocess
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

ORDERS, FILES = 6000, 24


def land(folder: Path) -> None:
    """Each order twice: inserted by the first half of the files, updated by the second."""
    folder.mkdir()
    half, share = FILES // 2, ORDERS // (FILES // 2)
    for number in range(FILES):
        first = number % half * share
        events = [
            {"order_id": first + i, "op_type": "I" if number < half else "U",
             "sequence_num": 1 + number // half}
            for i in range(share)
        ]
        (folder / f"{number:03d}.json").write_text("\n".join(map(json.dumps, events)))


def run(root: str) -> None:
    from conftest import new_session

    from strataflow.plans.refresh import Layout, ingest, promote, read_bronze, read_silver
    from strataflow.spec import BronzeSpec, SilverSpec, columns

    spark, lake = new_session(), Layout(f"{root}/lake")
    cols = columns("order_id long, op_type string, sequence_num long")
    both = ("order_id", "sequence_num")
    raw = BronzeSpec("orders", "json", columns=cols, landing=f"{root}/in",
                     read_options={"maxFilesPerTrigger": "1"})
    refined = [
        SilverSpec("current", "cdc_merge", "orders", ("order_id",), cols, buckets=4),
        SilverSpec("history", "cdc_history", "orders", both, cols),
        SilverSpec("stream", "streaming_append", "orders", both,
                   cols + columns("_ingested_at timestamp"), order_col="_ingested_at"),
    ]
    ingest(spark, raw, lake)
    for spec in refined:
        promote(spark, spec, raw, lake)
    counts = [read_bronze(spark, raw, lake).count()]
    counts += [read_silver(spark, spec, lake).count() for spec in refined]
    latest = read_silver(spark, refined[0], lake).filter("sequence_num = 2").count()
    assert counts == [2 * ORDERS, ORDERS, 2 * ORDERS, 2 * ORDERS], counts
    assert latest == ORDERS, latest


def main() -> None:
    root = tempfile.mkdtemp(prefix="run-crash-")
    land(Path(root) / "in")
    command = [sys.executable, __file__, root]
    for age in (7, 8.5, 10, 11.5, 13, 14.5):
        child = subprocess.Popen(command, stderr=subprocess.DEVNULL)
        try:
            child.wait(timeout=age)
            print(f"finished within {age} s")
        except subprocess.TimeoutExpired:
            child.kill()
            child.wait()
            print(f"killed after {age} s")
    subprocess.run(command, check=True, stderr=subprocess.DEVNULL)
    print("whole")


if __name__ == "__main__":
    run(sys.argv[1]) if len(sys.argv) > 1 else main()
