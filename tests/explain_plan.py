"""Print the formatted physical plan of registered queries:

    python tests/explain_plan.py /root/testdata/sf0.01 income_statement recon_drift
"""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    from ledgerlake import catalog
    from ledgerlake.session import local_session
    spark = local_session(8)
    sf_dir = argv[1]
    for key in argv[2:]:
        print(f"===== {key}")
        catalog.REGISTRY[key].run(spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
