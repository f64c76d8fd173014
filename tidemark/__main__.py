"""python -m tidemark MODE SOURCE TARGET [--rules FILE] [--sieve-rules FILE] [--csv]"""

import argparse
import json
import sys

from pyspark.sql import SparkSession

from . import packs
from .operators import sieve
from .operators.rules import validate
from .plans.pipeline import MODES, run


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("mode", choices=MODES)
    p.add_argument("source", nargs="?", default="")
    p.add_argument("target", nargs="?", default="")
    p.add_argument("--rules", help="a rule pack as JSON or YAML")
    p.add_argument("--sieve-rules", help="the sieve's configuration as JSON or YAML")
    p.add_argument("--csv", action="store_true")
    a = p.parse_args(argv)
    pack = packs.load(a.rules) if a.rules else packs.DEFAULT
    if a.mode == "validate-rules" and not a.target:
        found = validate(pack) + (packs.unknown_keys(a.rules) if a.rules else [])
        print("\n".join(map(" | ".join, found)))
        return int(any(level == "error" for level, _, _ in found))
    config = sieve.load_config(a.sieve_rules) if a.sieve_rules else sieve.SieveConfig()
    print(json.dumps(run(SparkSession.builder.appName("tidemark").getOrCreate(), a.source, a.target, a.mode, pack, a.csv, config)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
