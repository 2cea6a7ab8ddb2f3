import sys

from tessaria.plans.run import main

sys.exit(main(sys.argv[1:]))
