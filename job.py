"""Driver script of the jobs.

    spark-submit --py-files tallymart.zip job.py build|etl|load|export SOURCE TARGET \\
        --shuffle-partitions N [--raw-format csv|parquet] [--clean-format csv|parquet]
        [--rules FILE] [--report]

``build`` goes from the raw tables to the warehouse at once; ``etl`` and ``load`` do
the same in two steps with the clean zone between them; ``export`` writes the
dashboard payload.  Beside the package, the script needs no ``--py-files``.
"""

import sys

from tallymart.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])
