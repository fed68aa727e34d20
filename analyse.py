"""Script for ``spark-submit``: see ``daygrain/__main__.py``."""

from daygrain.__main__ import main

if __name__ == "__main__":
    main()
