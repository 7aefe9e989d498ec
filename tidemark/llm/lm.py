"""Language-model scores of whole texts.

Two scores for each text. The base score adds up smoothed log frequencies of
its words in the training documents; the words of a bounded chunk of documents
are counted together, so a word crosses the network once a chunk, with the list
of the chunk's documents that hold it. The same pass looks up the subword ids of
each of the chunk's words once and keeps every document's ids in the shared
folder; counting ids, training and scoring read those.

The model is one layer of causal self-attention over subword ids, trained in
numpy. It predicts the class of the next id; ids are put in classes by frequency
and drawn within a class by their counts, so the probabilities of all ids add up
to one. Texts are cut into blocks of ``BLOCK`` ids; a window is a block and the
block before it, windows overlap by half and score the ids of their last block,
so each id is scored once. Training runs on every partition at once and
averages; every window of all training documents is learned from once, one in ``ONE_IN`` each round.
"""

from __future__ import annotations

from functools import cache
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tokenizer_path, word_ids
from tidemark.session import cut_lineage, run_dir

#: Ids of the tokenizer: all, the mark before a text and the mark after it.
VOCABULARY, START, END = 49_408, 49_406, 49_407
BLOCK, WIDTH, CLASSES, OWN_ROWS = 32, 16, 64, 1024
#: Training rounds, of which each takes another one of ``ONE_IN`` windows, and windows in a step.
TRAIN_ROUNDS, ONE_IN, STEP = 2, 2, 64
#: Documents and bytes of text whose words are counted together.
CHUNK_DOCS, CHUNK_BYTES = 12_288, 32 << 20
SEED = 17


def held_out(doc_id: str = "doc_id"):
    """Not learned from: crc32 of the id's text leaves 1 when divided by 5. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


# Classes of ids


class Classes:
    """Class, share within the class and embedding row of every id, from the ids' training counts."""

    def __init__(self, counts):
        import numpy as np

        order = np.argsort(-counts, kind="stable")
        mass = np.cumsum(np.sqrt(counts[order] + 0.5))
        cls = np.minimum((mass / mass[-1] * CLASSES).astype(np.int64), CLASSES - 1)
        self.of = np.empty(VOCABULARY, np.int16)
        self.of[order] = cls
        smooth = counts + 0.5
        mass = np.bincount(self.of, smooth, CLASSES)
        self.log_share = np.log(smooth / mass[self.of])
        self.log_mass = np.log(np.maximum(mass, 1e-9) / mass.sum()).astype(np.float32)
        self.row = np.empty(VOCABULARY, np.int16)
        self.row[order] = np.minimum(np.arange(VOCABULARY), OWN_ROWS + cls)
        self.row[order[OWN_ROWS:]] = OWN_ROWS + cls[OWN_ROWS:]


def new_model(classes: Classes) -> dict:
    """The model before training: close to the frequencies of the classes."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    draw = lambda *shape: rng.normal(0, 0.3 / shape[0] ** 0.5 if shape[0] == WIDTH else 0.1, shape).astype(np.float32)
    return {
        "e": draw(OWN_ROWS + CLASSES, WIDTH), "q": draw(WIDTH, WIDTH), "k": draw(WIDTH, WIDTH), "v": draw(WIDTH, WIDTH),
        "near": np.zeros(2 * BLOCK, np.float32), "u": draw(WIDTH, CLASSES), "c": classes.log_mass.copy(),
    }


def blocks_of(texts: list, classes: Classes):
    """Windows of several id sequences: input rows ``(n, 2 * BLOCK)``, targets ``(n, BLOCK)``, -1 for none, first-block flags, text numbers."""
    import numpy as np

    lengths = np.array([len(t) for t in texts], np.int64)
    blocks = -(-lengths // BLOCK)
    # Each text has an empty block before it; inputs are shifted by the start mark.
    at = np.cumsum(blocks + 1) - blocks
    size = int((blocks + 1).sum())
    rows, ids = np.zeros(size * BLOCK, np.int16), np.full(size * BLOCK, -1, np.int32)
    for t, a in zip(texts, (at * BLOCK).tolist()):
        ids[a : a + len(t)] = t
        rows[a] = classes.row[START]
        rows[a + 1 : a + len(t)] = classes.row[t[:-1]]
    grid = rows.reshape(size, BLOCK)
    which = np.repeat(at, blocks) + np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return np.concatenate([grid[which - 1], grid[which]], axis=1), ids.reshape(size, BLOCK)[which], np.isin(which, at), np.repeat(np.arange(len(texts)), blocks)


@cache
def _distances():
    """Distance of each key of a window to each query, and where a key lies ahead."""
    import numpy as np

    far = (np.arange(BLOCK) + BLOCK)[:, None] - np.arange(2 * BLOCK)[None, :]
    return np.clip(far, 0, None), far < 0


def _mask(m: dict):
    import numpy as np

    far, ahead = _distances()
    return np.where(ahead, m["near"].dtype.type(-1e9), m["near"][far])


def _tables(m: dict):
    """Queries of every embedding row; its key, its value, a one that adds up weights and the row itself, side by side."""
    import numpy as np

    e = m["e"]
    return e @ m["q"] * e.dtype.type(WIDTH**-0.5), np.concatenate([e @ m["k"], e @ m["v"], np.ones((len(e), 1), e.dtype), e], axis=1)


#: Columns of the second table.
_KEY, _VALUE, _SUMMED, _ROW = slice(0, WIDTH), slice(WIDTH, 2 * WIDTH), slice(WIDTH, 2 * WIDTH + 1), slice(2 * WIDTH + 1, None)


class _Space:
    """Arrays for ``STEP`` windows, written over and over: fresh ones would have to be fetched into a core's cache each time."""

    def __init__(self, dtype):
        import numpy as np

        new = lambda *shape: np.empty((STEP, *shape), dtype)
        self.q, self.seen, self.s, self.summed = new(BLOCK, WIDTH), new(2 * BLOCK, 3 * WIDTH + 1), new(BLOCK, 2 * BLOCK), new(BLOCK, WIDTH + 1)
        self.mixed, self.z = new(BLOCK, WIDTH), new(BLOCK, CLASSES)
        # A last column of ones goes with the classes' own terms.
        self.h = np.ones((STEP, BLOCK, WIDTH + 1), dtype)
        self.back, self.ds, self.asked, self.sought = new(BLOCK, WIDTH + 1), new(BLOCK, 2 * BLOCK), new(BLOCK, 2 * WIDTH), new(2 * BLOCK, 2 * WIDTH)

    def cut(self, n: int) -> _Space:
        """The arrays' first ``n`` windows."""
        some = object.__new__(_Space)
        some.__dict__.update((k, x[:n]) for k, x in vars(self).items())
        return some


@cache
def _space(dtype: str) -> _Space:
    return _Space(dtype)


def _careless():
    """For numbers that overflow: they are seen afterwards, and the careful way is taken."""
    import numpy as np

    return np.errstate(over="ignore", invalid="ignore")


def attend(w: _Space, rows, first, tables, mask) -> None:
    """Weights ``s`` of each window's last block over the window, up to a factor for each query, the values ``summed`` with them, their mean ``mixed`` and the output ``h``.

    Exponents stay in range without their maximum being taken off, or else the
    careful way is taken.
    """
    import numpy as np

    tables[0].take(rows[:, BLOCK:], axis=0, out=w.q, mode="clip")
    tables[1].take(rows, axis=0, out=w.seen, mode="clip")
    s, begins = w.s, first.any()
    for careful in (False, True):
        np.matmul(w.q, w.seen[:, :, _KEY].transpose(0, 2, 1), out=s)
        s += mask
        if begins:
            s[first, :, :BLOCK] = -1e9
        if careful:
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        np.matmul(s, w.seen[:, :, _SUMMED], out=w.summed)
        weight = w.summed[:, :, WIDTH]
        if careful or weight.min() > 1e-25 and weight.max() < 1e28:
            break
    np.divide(w.summed[:, :, :WIDTH], w.summed[:, :, WIDTH:], out=w.mixed)
    np.add(w.mixed, w.seen[:, BLOCK:, _ROW], out=w.h[:, :, :WIDTH])


def class_odds(w: _Space, head, places):
    """Odds ``z`` of the classes in each row of ``h`` up to a factor, their sums, and the log probability at ``places`` of the flat odds."""
    import numpy as np

    z, flat = w.z.reshape(-1, CLASSES), w.z.reshape(-1)
    ones = np.ones(CLASSES, z.dtype)
    for careful in (False, True):
        np.matmul(w.h.reshape(-1, WIDTH + 1), head, out=z)
        if careful:
            z -= z.max(axis=1, keepdims=True)
        own = flat.take(places)
        np.exp(z, out=z)
        total = z @ ones
        if careful or total.min() > 1e-25 and total.max() < 1e28:
            break
    return total, own - np.log(total.take(places // CLASSES))


def _head(m: dict):
    import numpy as np

    return np.concatenate([m["u"], m["c"][None, :]])


def scores(m: dict, classes: Classes, texts: list):
    """Natural log probability of each id sequence, END included by the caller."""
    import numpy as np

    total = np.zeros(len(texts))
    rows, ids, first, owner = blocks_of(texts, classes)
    mask, tables, head = _mask(m), _tables(m), _head(m)
    with _careless():
        for a in range(0, len(rows), STEP):
            part = slice(a, a + STEP)
            w = _space(head.dtype.str).cut(len(rows[part]))
            attend(w, rows[part], first[part], tables, mask)
            target = ids[part].ravel()
            real = np.flatnonzero(target >= 0)
            target = target[real]
            _, found = class_odds(w, head, real * CLASSES + classes.of[target])
            total += np.bincount(owner[part][real // BLOCK], found + classes.log_share[target], len(texts))
    return total


def gradients(m: dict, rows, target_classes, first):
    """Mean loss over the real targets (class -1: none) and its gradient, a few windows at a time."""
    import numpy as np

    e, n = m["e"], len(rows)
    mask, tables, head, kind = _mask(m), _tables(m), _head(m), e.dtype
    count, loss, scale = max(1, int((target_classes >= 0).sum())), 0.0, kind.type(WIDTH**-0.5)
    u_back, asked_back = np.ascontiguousarray(m["u"].T), np.concatenate([m["q"] * scale, np.eye(WIDTH, dtype=kind)], axis=1)
    sought_back = np.concatenate([m["k"], m["v"]], axis=1)
    g_head, g_asked, g_sought, g_near = np.zeros_like(head), np.zeros_like(m["q"]), np.zeros_like(sought_back), np.zeros(BLOCK * 2 * BLOCK, kind)
    de = np.empty((WIDTH, n, 2 * BLOCK), kind)
    with _careless():
        for a in range(0, n, STEP):
            part = slice(a, a + STEP)
            some = len(rows[part])
            w = _space(kind.str).cut(some)
            attend(w, rows[part], first[part], tables, mask)
            t = target_classes[part].ravel()
            real = np.flatnonzero(t >= 0)
            places = real * CLASSES + t[real]
            total, found = class_odds(w, head, places)
            loss -= float(found.sum())
            share = np.zeros_like(total)
            share[real] = 1 / (total[real] * kind.type(count))
            dz = w.z.reshape(-1, CLASSES)
            dz *= share[:, None]
            dz.reshape(-1)[places] -= kind.type(1 / count)
            g_head += w.h.reshape(-1, WIDTH + 1).T @ dz
            asked, sought, back, ds = w.asked, w.sought, w.back, w.ds
            dh = asked[:, :, WIDTH:]
            np.matmul(dz, u_back, out=asked.reshape(-1, 2 * WIDTH)[:, WIDTH:])
            # The ones beside the values take off each query's mean.
            np.divide(dh, w.summed[:, :, WIDTH:], out=back[:, :, :WIDTH])
            np.negative(np.vecdot(back[:, :, :WIDTH], w.mixed), out=back[:, :, WIDTH])
            np.matmul(back, w.seen[:, :, _SUMMED].transpose(0, 2, 1), out=ds)
            ds *= w.s
            g_near += np.ones(some, kind) @ ds.reshape(some, -1)
            np.matmul(ds, w.seen[:, :, _KEY], out=asked[:, :, :WIDTH])
            np.matmul(ds.transpose(0, 2, 1), w.q, out=sought[:, :, :WIDTH])
            np.matmul(w.s.transpose(0, 2, 1), back[:, :, :WIDTH], out=sought[:, :, WIDTH:])
            x = w.seen[:, :, _ROW]
            g_asked += x[:, BLOCK:].reshape(-1, WIDTH).T @ asked.reshape(-1, 2 * WIDTH)[:, :WIDTH]
            g_sought += w.seen.reshape(-1, 3 * WIDTH + 1)[:, _ROW].T @ sought.reshape(-1, 2 * WIDTH)
            de[:, part] = (sought_back @ sought.reshape(-1, 2 * WIDTH).T).reshape(WIDTH, some, -1)
            de[:, part, BLOCK:] += (asked_back @ asked.reshape(-1, 2 * WIDTH).T).reshape(WIDTH, some, -1)
    far, ahead = _distances()
    at = rows.ravel().astype(np.int64)
    g = {"u": g_head[:WIDTH], "c": g_head[WIDTH], "q": g_asked * scale, "k": g_sought[:, :WIDTH], "v": g_sought[:, WIDTH:]}
    g["near"] = np.bincount(far[~ahead], g_near.reshape(far.shape)[~ahead], 2 * BLOCK).astype(kind)
    g["e"] = np.stack([np.bincount(at, col, len(e)) for col in de.reshape(WIDTH, -1)], axis=1).astype(kind)
    return loss / count, g


def adam(m: dict, batches, rate: float = 0.01) -> int:
    """Steps over the batches in place; the number of steps."""
    import numpy as np

    flat = np.concatenate([x.ravel() for x in m.values()])
    ends = np.cumsum([x.size for x in m.values()])[:-1]
    views = {k: part.reshape(x.shape) for (k, x), part in zip(m.items(), np.split(flat, ends))}
    first, second, n = np.zeros_like(flat), np.zeros_like(flat), 0
    for batch in batches:
        _, found = gradients(views, *batch)
        n += 1
        g = np.concatenate([found[k].ravel() for k in m])
        first *= 0.9
        first += 0.1 * g
        second *= 0.99
        g *= g
        g *= 0.01
        second += g
        scale = np.sqrt(second / (1 - 0.99**n))
        scale += 1e-8
        flat -= first / scale * (rate / (1 - 0.9**n))
    for k, x in m.items():
        x[...] = views[k]
    return n


# Work on Spark


def _coded(texts: list, path: str):
    """Id sequences of texts with the end mark."""
    import numpy as np

    ids, end = word_ids(path), END.to_bytes(4, "little")
    return [np.frombuffer(ids.of_words((t or b"").lower().split()) + end, "<u4").astype(np.uint16) for t in texts]


def _parts(batch, rows: int = 256, size: int = 4 << 20):
    """An Arrow batch in slices of bounded rows and bytes of its last column."""
    import pyarrow.compute as pc

    n = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    a, held = 0, 0
    for k, x in enumerate(n.tolist()):
        if k > a and (held + x > size or k - a >= rows):
            yield batch.slice(a, k - a)
            a, held = k, 0
        held += x
    if len(n) > a:
        yield batch.slice(a)


def _read(ids) -> list:
    """Id sequences from an Arrow column of 16-bit ids."""
    import numpy as np

    return [np.frombuffer(x, "<u2") for x in ids.to_pylist()]


def id_counts(coded: DataFrame):
    """How often each subword id occurs in ``coded(ids)``."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        total = np.zeros(VOCABULARY, np.int64)
        for b in batches:
            for part in _parts(b):
                total += np.bincount(np.concatenate(_read(part.column(0))), minlength=VOCABULARY)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["id", "n"])

    rows = coded.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(VOCABULARY)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def _averaged(updates: DataFrame, groups: int) -> dict | None:
    """Mean of the models weighted by their steps: in groups first, so the driver gets a bounded number."""
    import pickle

    def mean(pairs):
        total, weight = None, 0
        for steps, blob in pairs:
            m = pickle.loads(blob)
            weight += steps
            total = {k: x * steps + (total[k] if total else 0) for k, x in m.items()}
        return ({k: (x / weight).astype("float32") for k, x in total.items()}, weight) if weight else (None, 0)

    def run(key, rows):
        import pyarrow as pa

        m, weight = mean(zip(rows.column("steps").to_pylist(), rows.column("model").to_pylist()))
        return pa.table({"steps": pa.array([weight], pa.int64()), "model": pa.array([pickle.dumps(m)], pa.binary())})

    grouped = updates.withColumn("g", F.pmod("task", F.lit(groups))).groupBy("g").applyInArrow(run, "steps bigint, model binary")
    return mean((r["steps"], r["model"]) for r in grouped.collect())[0]


def _turn(coded: list, marks, classes: Classes, one_in: int, turn: int):
    """Of the windows of id sequences, every ``one_in``-th, counted from each text's mark."""
    import numpy as np

    rows, ids, first, owner = blocks_of(coded, classes)
    starts = np.flatnonzero(first)
    number = np.arange(len(owner)) - starts[owner] + marks[owner]
    mine = number % one_in == turn % one_in
    ids = ids[mine]
    return rows[mine], np.where(ids >= 0, classes.of[np.maximum(ids, 0)].astype(np.int64), -1), first[mine]


def drawn(texts: list, classes: Classes, path: str, one_in: int, turn: int):
    """Of the windows of texts, every ``one_in``-th; as many turns draw each window once. Input rows, classes of the targets (-1: none), first-block flags."""
    import numpy as np

    return _turn(_coded(texts, path), np.array([crc32(t or b"") for t in texts], np.int64), classes, one_in, turn)


def train(docs: DataFrame, classes: Classes, path: str, rounds: int = TRAIN_ROUNDS, one_in: int = ONE_IN) -> dict:
    """The model of ``docs(text)``, whose ids are looked up in every round."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for part in _parts(b):
                texts = part.column(0).to_pylist()
                marks = np.array([crc32(t or b"") for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(marks), pa.array([c.tobytes() for c in _coded(texts, path)], pa.binary())], ["mark", "ids"])

    return train_coded(docs.mapInArrow(run, "mark bigint, ids binary"), classes, rounds, one_in)


def train_coded(coded: DataFrame, classes: Classes, rounds: int = TRAIN_ROUNDS, one_in: int = ONE_IN) -> dict:
    """Rounds over ``coded(mark, ids)``: each partition trains on its windows from the shared model, then the models are averaged."""
    import numpy as np

    model, coded = new_model(classes), coded.select("mark", "ids")
    for r in range(rounds):

        def run(batches, model=model, r=r):
            import pickle

            import pyarrow as pa
            from pyspark import TaskContext

            own = {k: x.copy() for k, x in model.items()}

            def windows():
                for b in batches:
                    for part in _parts(b):
                        found = _turn(_read(part.column(1)), part.column(0).to_numpy(), classes, one_in, r)
                        if len(found[0]):
                            yield found

            def steps():
                held, size = [], 0
                for w in windows():
                    held.append(w)
                    size += len(w[0])
                    if size >= STEP:
                        every = [np.concatenate(c) for c in zip(*held)]
                        whole = size // STEP * STEP
                        for a in range(0, whole, STEP):
                            yield [c[a : a + STEP] for c in every]
                        held, size = [[c[whole:] for c in every]], size - whole
                if size:
                    yield [np.concatenate(c) for c in zip(*held)]

            n = adam(own, steps(), 0.01 / (1 + r))
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([pickle.dumps(own)], pa.binary())], ["task", "steps", "model"])

        updates = coded.mapInArrow(run, "task bigint, steps bigint, model binary")
        model = _averaged(updates, groups=16) or model
    return model


def model_scores(coded: DataFrame, model: dict, classes: Classes) -> DataFrame:
    """``digest, score`` of each distinct text of ``coded(digest, ids)``: log10 probability, by the text's MD5."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for part in _parts(b, 128, 1 << 19):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(model, classes, _read(part.column(1))) / np.log(10))], ["digest", "score"])

    return coded.select("digest", "ids").mapInArrow(run, "digest binary, score double").groupBy("digest").agg(F.min("score").alias("score"))


#: Rows of a chunk: one head with the documents, one row a word, one row a text, and for each document its subword ids.
HEAD, WORD, TEXT, IDS = 0, 1, 2, 3


class _Words(dict):
    """Numbers of a chunk's words in the order they are met, and each word's subword ids."""

    def __init__(self, path: str):
        # The empty word stands for the end of a text.
        super().__init__({b"": 0})
        self.known, self.ids = word_ids(path), [END.to_bytes(4, "little")]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.ids)
        self.ids.append(self.known[word])
        return n


class _Chunk:
    """Documents whose words are counted together: postings of (document, times) in the order of the words."""

    def __init__(self, path: str):
        self.words, self.texts = _Words(path), {}
        self.ids, self.held, self.sizes, self.text_of, self.bytes = [], [], [], [], 0
        self.postings, self.run, self.done = [], [], 0

    def add(self, doc_id, held: bool, text: bytes) -> tuple:
        """The text's digest (null if it was here before), whether it is learned from, its mark and its ids as bytes."""
        from hashlib import md5

        import numpy as np

        numbers = [*map(self.words.__getitem__, text.lower().split()), 0]
        self.run.append(np.array(numbers, np.uint64))
        self.ids.append(doc_id)
        self.held.append(held)
        self.sizes.append(len(numbers))
        digest, known = md5(text).digest(), len(self.texts)
        self.text_of.append(self.texts.setdefault(digest, known))
        self.bytes += len(text)
        ids = np.frombuffer(b"".join(map(self.words.ids.__getitem__, numbers)), "<u4").astype("<u2")
        return digest if len(self.texts) > known else None, int(not held), crc32(text), ids.tobytes()

    def fold(self) -> None:
        """Postings of the documents since the last call, each as one number: word, document, times."""
        import numpy as np

        if not self.run:
            return
        every = np.concatenate(self.run)
        every <<= np.uint64(16)
        every |= np.repeat(np.arange(self.done, len(self.ids), dtype=np.uint64), self.sizes[self.done :])
        every.sort()
        at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        times, every = np.diff(np.r_[at, len(every)]), every[at]
        # A byte holds 255; the rest is in further postings.
        more = -(-times // 255)
        last = np.cumsum(more) - 1
        part = np.full(int(more.sum()), 255, np.uint64)
        part[last] = times - 255 * (more - 1)
        self.postings.append(np.repeat(every, more) << np.uint64(8) | part)
        self.run, self.done = [], len(self.ids)

    def rows(self, chunk: int):
        import pickle

        import numpy as np
        import pyarrow as pa

        self.fold()
        every, self.postings = np.concatenate(self.postings), []
        every.sort()
        times = every.astype(np.uint8)
        every >>= np.uint64(8)
        doc = every.astype(np.uint16)
        every >>= np.uint64(16)
        # Each word has a posting, so these are the words by their numbers.
        at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        lengths = np.diff(np.r_[at, len(every)]).astype(np.uint32)
        del every
        learned = np.add.reduceat(times * ~np.array(self.held, bool)[doc], at, dtype=np.int64)
        postings = (lengths.tobytes(), doc.tobytes(), times.tobytes())
        head = pickle.dumps((self.ids, self.held, self.sizes, self.text_of, postings))
        yield _rows_of(chunk, HEAD, [b""], [0], [0], [head])
        for kind, keys, counts in ((WORD, list(self.words), learned), (TEXT, list(self.texts), np.zeros(len(self.texts), np.int64))):
            for a in range(0, len(keys), 50_000):
                part = keys[a : a + 50_000]
                yield _rows_of(chunk, kind, part, np.arange(a, a + len(part)), counts[a : a + len(part)])


def _rows_of(chunk: int, kind: int, keys, at, learned, heads=None, marks=None, ids=None):
    """Rows of a chunk as an Arrow batch."""
    import numpy as np
    import pyarrow as pa

    n = len(keys)
    columns = [np.full(n, chunk), np.full(n, kind, np.int8)]
    columns = [*map(pa.array, columns), pa.array(keys, pa.binary()), pa.array(at, pa.int32()), pa.array(learned, pa.int64())]
    extra = [pa.array(x, t) if x is not None else pa.nulls(n, t) for x, t in ((heads, pa.binary()), (marks, pa.int64()), (ids, pa.binary()))]
    return pa.RecordBatch.from_arrays(columns + extra, ["chunk", "kind", "key", "at", "learned", "head", "mark", "ids"])


def _chunks(docs: DataFrame, path: str) -> DataFrame:
    """The chunks of ``docs(doc_id, held_out, text)`` as head, word and text rows, and each document's ids in the order of the documents."""

    def run(batches):
        from pyspark import TaskContext

        task, serial, held = TaskContext.get().partitionId(), 0, _Chunk(path)

        def coded(found):
            digests, learned, marks, ids = zip(*found)
            return _rows_of(task << 32 | serial, IDS, digests, [None] * len(ids), learned, None, marks, ids)

        for b in batches:
            for part in _parts(b):
                found = []
                for doc_id, out, text in zip(*(c.to_pylist() for c in part.columns)):
                    if held.ids and (len(held.ids) >= CHUNK_DOCS or held.bytes + len(text) > CHUNK_BYTES):
                        if found:
                            yield coded(found)
                        yield from held.rows(task << 32 | serial)
                        held, serial, found = _Chunk(path), serial + 1, []
                    found.append(held.add(doc_id, out, text))
                held.fold()
                if found:
                    yield coded(found)
        if held.ids:
            yield from held.rows(task << 32 | serial)

    return docs.mapInArrow(run, "chunk bigint, kind tinyint, key binary, at int, learned bigint, head binary, mark bigint, ids binary")


def _finish(population: int, distinct: int):
    """Both scores of one chunk's documents from the answers to its words and texts."""

    def run(key, rows):
        import pickle

        import numpy as np
        import pyarrow as pa

        kind, at, value = (rows.column(c).to_numpy() for c in ("kind", "at", "value"))
        ids, held, sizes, text_of, (lengths, doc, times) = pickle.loads(next(h for h in rows.column("head").to_pylist() if h is not None))
        lengths, doc, times = np.frombuffer(lengths, np.uint32), np.frombuffer(doc, np.uint16), np.frombuffer(times, np.uint8)
        n, count, score = len(ids), np.zeros(len(lengths)), np.zeros(max(text_of) + 1)
        count[at[kind == WORD]] = value[kind == WORD]
        score[at[kind == TEXT]] = value[kind == TEXT]
        worth = np.log10((count + 0.5) / (population + 0.5 * (distinct + 1)))
        base = np.bincount(doc, times * np.repeat(worth, lengths), n)
        known = np.bincount(doc, times * np.repeat(count > 0, lengths), n).astype(np.int64)
        return pa.table([
            pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(sizes, pa.int64()), pa.array(known), pa.array(np.full(n, population), pa.int64()), pa.array(base), pa.array(score[np.array(text_of)]),
        ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs(doc_id, text)``.

    A null text is an empty one, which has the end token alone; repeated rows
    are scored and learned from each; extra columns are not read. Without
    training documents all words are unknown and the model is the untrained one.
    """
    path = path or tokenizer_path()
    rows = docs.select("doc_id", held_out().alias("held_out"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    folder = f"{run_dir(docs.sparkSession, 'lm')}/chunks"
    _chunks(rows, path).write.parquet(folder)
    parts = docs.sparkSession.read.parquet(folder)
    words = parts.where(F.col("kind") == WORD)
    counts = cut_lineage(words.groupBy("key").agg(F.sum("learned").alias("c")).where("c > 0").withColumnRenamed("key", "word"))
    population, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    coded = parts.where(F.col("kind") == IDS)
    learned = coded.where("learned > 0")
    classes = Classes(id_counts(learned))
    model = train_coded(learned, classes)
    scored = model_scores(coded.where("key IS NOT NULL").withColumnRenamed("key", "digest"), model, classes)
    # Words without an answer were never learned; each answer is one number.
    answers = words.select("chunk", "kind", "key", "at").join(counts.select(F.col("word").alias("key"), F.col("c").cast("double").alias("value")), "key")
    texts = parts.where(F.col("kind") == TEXT).select("chunk", "kind", "key", "at").join(scored.select(F.col("digest").alias("key"), F.col("score").alias("value")), "key")
    heads = parts.where(F.col("kind") == HEAD).select("chunk", "kind", "at", F.lit(0.0).alias("value"), "head")
    every = answers.unionByName(texts).drop("key").withColumn("head", F.lit(None).cast("binary")).unionByName(heads)
    found = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return every.groupBy("chunk").applyInArrow(_finish(population, distinct), found)
