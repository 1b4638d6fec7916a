"""spark-submit entry point of the conversion job.

    cd <repo> && zip -r ledgergraph.zip ledgergraph
    spark-submit --py-files ledgergraph.zip convert_job.py <input path> <output dir> [debug]
"""

from ledgergraph.plans.job import main

if __name__ == "__main__":
    main()
