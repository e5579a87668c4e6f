from gamestats.cli import main

main()
