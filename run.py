"""For spark-submit: ``zip -r waymill.zip waymill && spark-submit --py-files waymill.zip run.py fares --folder … --out …``."""

from waymill.__main__ import main

if __name__ == "__main__":
    main()
