from .streaming.cli import main

main()
