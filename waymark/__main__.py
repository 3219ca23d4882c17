from waymark.cli import main

main()
