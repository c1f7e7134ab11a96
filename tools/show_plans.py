"""Print the formatted physical plan of registered queries.

usage: python tools/show_plans.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from celltally import queries as Q  # noqa: E402
from celltally.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1]
    spark = local_session(8)
    for key in sys.argv[2:]:
        print(f"===== {key}")
        Q.REGISTRY[key](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
