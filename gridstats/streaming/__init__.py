"""Bronze as a stream of arriving play files."""
