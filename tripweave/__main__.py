from tripweave.jobs import main

main()
