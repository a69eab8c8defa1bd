"""Entry point for ``spark-submit``: see :mod:`terravane.jobs`."""

from terravane.jobs import main

if __name__ == "__main__":
    main()
