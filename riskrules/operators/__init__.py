"""DataFrame to DataFrame operators, lazily evaluated unless their docstring says otherwise."""
