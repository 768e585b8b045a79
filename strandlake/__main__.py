import sys

from strandlake.plans.cli import main

sys.exit(main())
