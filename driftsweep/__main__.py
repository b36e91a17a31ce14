from driftsweep.plans.run import main

main()
