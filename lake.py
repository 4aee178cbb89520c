"""Script for spark-submit; on a cluster add the package with --py-files."""

from pavelake.__main__ import main

if __name__ == "__main__":
    main()
