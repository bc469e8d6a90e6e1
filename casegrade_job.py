"""spark-submit launcher for the casegrade command line.

    zip -r casegrade.zip casegrade
    spark-submit --py-files casegrade.zip casegrade_job.py all --base s3://bucket/claims
"""

import sys

from casegrade.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
