from reviewloom.plans.cli import main

main()
