from ridgeway.cli import main

main()
