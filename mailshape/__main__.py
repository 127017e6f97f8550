"""``python -m mailshape TRAIN_CSV TEST_FOLDER OUTPUT [LEXICON_PARQUET [EXCEPTIONS_PARQUET]]``"""

from __future__ import annotations

import sys

from mailshape.plans.full_run import full_run
from mailshape.session import build_session
from mailshape.sources.csv_mail import load_training_mails
from mailshape.sources.raw_mail import load_raw_mails


def main(arguments: list[str]) -> int:
    if not 3 <= len(arguments) <= 5:
        print(__doc__, file=sys.stderr)
        return 2
    train, test, output, *tables = arguments
    spark = build_session()
    lexicon, exceptions = ([spark.read.parquet(t) for t in tables] + [None, None])[:2]
    reports = full_run(load_training_mails(spark, train), load_raw_mails(spark, test), output,
                       lexicon=lexicon, exceptions=exceptions)
    reports["comparison"].show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
