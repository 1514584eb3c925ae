import sys

from linkmill.plans.pipeline import main

sys.exit(main())
