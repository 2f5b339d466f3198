from murmuration.cli import main

main()
