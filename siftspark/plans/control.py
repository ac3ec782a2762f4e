"""A small web interface to runs: configurations, start and stop, status, and the log as server-sent events.

``python -m siftspark.plans.control --folder configs --command "python -m siftspark.plans.cli screen ..."``; ``{config}`` in the
command stands for the configuration's file. One run at a time.
"""

from __future__ import annotations

import argparse
import json
import re
import shlex
import subprocess
import threading
import time
from collections import deque
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

from siftspark.streaming.progress import MODULES

NAME = re.compile(r"[\w-]{1,100}")
MODULE = re.compile(r"MODULE ([a-z_]+):")
PERCENT = re.compile(r"^\s*(\d{1,3})%\s+\d+:\d+=")


class Run:
    """One run of the command at a time, its last lines, and how far it is by the modules that it announces."""

    def __init__(self, command: list[str], keep: int = 1000) -> None:
        self.command, self.lines, self.count = command, deque(maxlen=keep), 0
        self.process: subprocess.Popen | None = None
        self.module: str | None = None
        self.completed: list[str] = []
        self.percent: int | None = None
        self.news = threading.Condition()

    def start(self, config: Path) -> bool:
        with self.news:
            if self.running():
                return False
            self.lines.clear()
            self.module, self.completed, self.percent, self.count = None, [], None, 0
            self.process = subprocess.Popen([part.format(config=config) for part in self.command], stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True)
        threading.Thread(target=self._read, args=(self.process,), daemon=True).start()
        return True

    def _read(self, process: subprocess.Popen) -> None:
        for line in process.stdout:
            self.take(line.rstrip("\n"))
        process.wait()
        with self.news:
            self.news.notify_all()

    def take(self, line: str) -> None:
        """A line of the log."""
        with self.news:
            self.count += 1
            self.lines.append({"seq": self.count, "ts": time.strftime("%Y-%m-%d %H:%M:%S"), "message": line})
            found = MODULE.search(line)
            if found and found[1] in MODULES and found[1] != self.module:
                if self.module:
                    self.completed.append(self.module)
                self.module, self.percent = found[1], None
            elif percent := PERCENT.match(line):
                self.percent = int(percent[1])
            self.news.notify_all()

    def running(self) -> bool:
        return self.process is not None and self.process.poll() is None

    def stop(self) -> bool:
        if not self.running():
            return False
        self.process.terminate()
        return True

    def status(self) -> dict:
        place = MODULES.index(self.module) if self.module else 0
        return {"running": self.running(), "exit": None if self.process is None else self.process.poll(), "module": self.module, "completed": list(self.completed), "progress": place * 100 // (len(MODULES) - 1), "percent": self.percent, "lines": self.count}

    def after(self, seq: int, wait: float) -> list[dict]:
        """The kept lines after one, waiting for some for a while."""
        with self.news:
            if self.count <= seq and self.running():
                self.news.wait(wait)
            return [x for x in self.lines if x["seq"] > seq]


def server(folder: str, command: list[str], port: int = 0, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """GET / /api/configs /api/config/NAME /api/status /api/events; POST /api/config/NAME /api/start /api/stop."""
    home, run = Path(folder), Run(command)
    home.mkdir(parents=True, exist_ok=True)

    class Handler(BaseHTTPRequestHandler):
        def answer(self, code: int, body: object, kind: str = "application/json") -> None:
            data = body.encode() if isinstance(body, str) else json.dumps(body).encode()
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def config(self, name: str) -> Path | None:
            if not NAME.fullmatch(name):
                self.answer(400, {"error": "bad name"})
                return None
            return home / f"{name}.json"

        def do_GET(self) -> None:  # noqa: N802
            if self.path == "/":
                self.answer(200, "<!DOCTYPE html><title>Runs</title><pre id=o></pre><script>new EventSource('/api/events').onmessage = e => o.textContent += JSON.parse(e.data).message + '\\n'</script>", "text/html")
            elif self.path == "/api/configs":
                self.answer(200, sorted(p.stem for p in home.glob("*.json")))
            elif self.path.startswith("/api/config/"):
                path = self.config(self.path.removeprefix("/api/config/"))
                if path is not None:
                    self.answer(*((200, path.read_text()) if path.exists() else (404, {"error": "no such configuration"})))
            elif self.path == "/api/status":
                self.answer(200, run.status())
            elif self.path == "/api/events":
                self.send_response(200)
                self.send_header("Content-Type", "text/event-stream")
                self.end_headers()
                seq = 0
                while True:
                    for line in run.after(seq, 1.0):
                        seq = line["seq"]
                        self.wfile.write(f"data: {json.dumps(line)}\n\n".encode())
                    self.wfile.write(f"event: status\ndata: {json.dumps(run.status())}\n\n".encode())
                    if not run.running() and seq >= run.count:
                        return
            else:
                self.answer(404, {"error": "no such page"})

        def do_POST(self) -> None:  # noqa: N802
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)) or b"{}")
            except ValueError:
                self.answer(400, {"error": "not JSON"})
                return
            if self.path.startswith("/api/config/"):
                path = self.config(self.path.removeprefix("/api/config/"))
                if path is not None:
                    path.write_text(json.dumps(body, indent=1))
                    self.answer(200, {"saved": path.stem})
            elif self.path == "/api/start":
                path = self.config(str(body.get("config", "")))
                if path is not None:
                    self.answer(*((404, {"error": "no such configuration"}) if not path.exists() else (200, {"started": True}) if run.start(path) else (409, {"error": "running"})))
            elif self.path == "/api/stop":
                self.answer(*((200, {"stopped": True}) if run.stop() else (409, {"error": "not running"})))
            else:
                self.answer(404, {"error": "no such page"})

        def log_message(self, *args: object) -> None:
            """No log of requests."""

    made = ThreadingHTTPServer((host, port), Handler)
    made.run = run
    return made


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="siftspark-control")
    parser.add_argument("--folder", required=True)
    parser.add_argument("--command", required=True)
    parser.add_argument("--port", type=int, default=5000)
    args = parser.parse_args(argv)
    server(args.folder, shlex.split(args.command), args.port).serve_forever()


if __name__ == "__main__":
    main()
