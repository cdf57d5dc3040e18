from gleaner.cli import main

main()
