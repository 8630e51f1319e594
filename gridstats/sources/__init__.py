"""Where plays come from and where layers are kept."""
