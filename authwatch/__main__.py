from authwatch.jobs.cli import main

main()
