"""DataFrame operators; every function is lazy unless its docstring says otherwise."""
