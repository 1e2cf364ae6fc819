"""Entry point for spark-submit; see ``--help``."""

from tripmetrics.cli import main

if __name__ == "__main__":
    main()
