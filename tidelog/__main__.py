"""Command line: view a log folder, or copy one.

    python -m tidelog view dir:PATH [FOLLOW] [LOCATION]
    python -m tidelog dump dir:PATH TARGET [FROM-FILE]

LOCATION is earliest, latest, FILE or FILE:POS.  FOLLOW 0 ends at the end of the log; any other number
goes on with events as they are appended.
"""

from __future__ import annotations

import sys
import tempfile

from pyspark.sql import SparkSession

from .operators import maintenance


def main(args: list[str]) -> int:
    if len(args) < 2 or args[0] not in ("view", "dump") or not args[1].startswith("dir:"):
        print(__doc__, file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("tidelog").config("spark.ui.enabled", "false").getOrCreate()
    path = args[1][4:]
    if args[0] == "dump":
        if len(args) < 3:
            print(__doc__, file=sys.stderr)
            return 2
        for r in maintenance.copy_log(spark, path, args[2], args[3] if len(args) > 3 else None).toLocalIterator():
            print(r["file"], r["bytes"])
        return 0
    if len(args) > 2 and args[2] not in ("", "0"):
        with tempfile.TemporaryDirectory() as checkpoint:
            maintenance.follow(spark, path, print, checkpoint, startingPosition=args[3] if len(args) > 3 else None).awaitTermination()
        return 0
    lines = maintenance.view(spark, path, startingPosition=args[3] if len(args) > 3 else None)
    for r in lines.orderBy("file_seq", "start_pos", "line_no").toLocalIterator():
        print(r["line"])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
