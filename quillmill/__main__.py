from quillmill.commands import main

main()
