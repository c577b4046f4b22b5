from loanlake.plans.backfill import main

main()
