"""Entry script for spark-submit: `spark-submit job.py silver --root hdfs://host:9000`."""

from rivulet.__main__ import main

if __name__ == "__main__":
    main()
