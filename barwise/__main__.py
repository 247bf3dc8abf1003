from barwise.cli import main

main()
