from ambry.cli import main

main()
